"""Secret scans: patterns, and the guess cost of values that stand in a credential's context.

Three patterns give the base spans (assignments to credential names, access key ids, long hex
strings). Beyond them, values that follow a credential word are judged by how many guesses they
would take: a dynamic programme over the value finds the cheapest segmentation into dictionary
words, dates, repeats, keyboard walks and brute-force spans, in bits. Values that cost at least
``min_bits`` are reported as spans of kind ``guess``, also where a base span covers them; base spans
always stay. The dictionary is a short list of common passwords and words, and behind it the most
frequent words of the corpus itself (``dictionary_words`` of them travel to the tasks).

Defined results: a null or empty text has no span; offsets count code points, ends are exclusive;
repeated rows get the same answer each; an empty table gives an empty result. Columns other than
the id and the text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, stable, with_row_id

# The base patterns, their least lengths, and the kinds in order.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

#: Words that announce a credential, and what may stand between one and its value.
CONTEXT = (r"(?<![A-Za-z])(?:password|passwd|passphrase|passcode|pwd|secret|token|credentials?|api[_ -]?key"
           r"|access[_ -]?key|private[_ -]?key|bearer|authorization|login)[A-Za-z_]{0,8}"
           r"""["'\x20]{0,3}(?:[:=]|\x20is\x20|(?<=earer)\x20)[\x20"']{0,3}([^\s"'<>,;]{6,})""")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "key", "bearer", "authorization", "login")
MIN_BITS = 32.0

#: Words that attackers try first, most common first (own list), and keyboard rows.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login hello sunshine princess football "
    "baseball shadow superman batman michael jordan hunter killer trustno soccer charlie andrew daniel jessica "
    "summer winter spring autumn monday friday january december secret token test guest root user default "
    "changeme temp demo example sample the and you love money computer internet server system database network "
    "company office home family house water orange banana apple purple green yellow silver golden happy magic "
    "pepper ginger cookie cheese flower tiger eagle horse london paris berlin madrid england france germany "
    "spain america star moon earth music guitar piano freedom power access account service private public key"
).split()
#: Words of running text that may follow a credential word, and their endings (own list); they rank behind the others.
PROSE_WORDS = (
    "able about above absent accept accepted according account across active actual added address after again against all "
    "allow allowed almost already also always among another any app application approved around ask assigned "
    "associated attached attempt auth authenticate available back bad base based because become been before being "
    "below best better between big blank both bound broken browser built but button call called can cannot card care "
    "case change changed character check checked choice choose chosen clear click client close code come common "
    "complete complex compromised config configured confirm confirmed connect contain contained control copy "
    "correct could create created credential current data date day dead decide decrypt default defined delete "
    "deleted denied depend describe device different digit directly disable disabled display does done down due "
    "each early easily easy either email empty enable enabled encode encoded encrypt encrypted end enough ensure "
    "enter entered entire entirely error essential even ever every exact exactly exchange exist expect expected "
    "expire expired expires explain expose exposed extremely fail failed false far field file final find fine first "
    "follow following for forget forgot forgotten form format found four free from full generate generated get "
    "give given going good granted great group guess had hand hard has hash hashed have held help here hidden high "
    "his hold how however identical identify ignore ignored immediately implement important impossible include "
    "included incorrect indeed individual information inside instead intend interest invalid issue issued its just "
    "keep kept know known large last later least leaked left length less let letter life like likely limit limited "
    "line link linked list little local lock locked long longer look lost lower made mail main make managed mandatory "
    "many match matched may mean meant memory method might missing mobile mode more most move much must name named "
    "necessary need needed never new next nil none normal not note nothing now null number obtain obtained obvious off "
    "often old once one only onto open option optional order original other our out outside over own page part pass "
    "passed people perhaps permanent person phone place plain point possible power present probably problem process "
    "production protect protected provide provided put quite random rather read ready real really reason receive "
    "received recommended refresh refused register registered reject rejected related remain remember remove "
    "removed renewed replace replaced request require required reset respect responsible restricted result return "
    "returned reused revoke revoked right rotate rotated safe said same save saved say second section secure secured "
    "security see seem send sensitive sent separate session set several share shared short should show shown side "
    "sign signed similar simple simply since single site small some something sort special specific specified split "
    "start state step still stolen stop store stored string strong subject submit submitted such sufficient support "
    "supposed sure take taken tell temporarily temporary than that their them then there these they thing think this those though "
    "three through time today together told too transmitted true trust try turn two type typed under undefined unfortunately "
    "unique unknown unless until update updated upon use used useful usually valid validate validated value various "
    "verified verify very visible wait want was way weak week well were what when where whether which while who whole "
    "whose why wide will with within without word work world would write written wrong year yes yet you your "
    "ability able ably ally ance ated ates ating ation ations ence ency ened ened ers est ful hood ible ical ied ies "
    "ified ify ing ings ion ions ise ised ish ism ist ity ive ively ize ized less like ling ment ments ness ology ous "
    "ously sion ted ting tion tions tive ular ward ways wise con dis inter mis non over pre pro sub super trans "
    "under"
).split()
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("0134578@$!", "oieastbasi")

_assign = re.compile(ASSIGN, re.I | re.A)
_access = re.compile(ACCESS)
_hex = re.compile(HEX)
_context = re.compile(CONTEXT, re.I | re.A)
#: Patterns of dates and how many there are of each kind.
_dates = [(re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])", re.A), 36525),
          (re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d", re.A), 36525),
          (re.compile(r"(?:19|20)\d\d", re.A), 100)]
_learnable = re.compile("[a-z]{3,24}")
#: Words learned from the corpus, and words a task holds before it hands their counts on.
LEARNED_WORDS, HELD_WORDS = 20_000, 200_000
#: Rarer words are not learned: a leaked value and its copies are no word.
LEARNED_COUNT = 50
LONGEST_UNIT = 4  # characters of a repeated unit
WALK_STARTS = 47 * 2
_hex_bytes = bytes(49 if 48 <= b <= 57 or 97 <= b <= 102 else 48 for b in range(256))
_neighbours = {(a, b) for row in (*KEYBOARD_ROWS, "abcdefghijklmnopqrstuvwxyz") for x, y in zip(row, row[1:])
               for a, b in ((x, y), (y, x))}


def _character_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26) if c.islower() else math.log2(26) + 1
    return math.log2(33) if c.isascii() else math.log2(1000)


class Dictionary:
    """Words and their cost in bits, by rank; words learned from a corpus rank behind the lists."""

    def __init__(self, learned: list[str] = ()):
        ranked = dict.fromkeys((*COMMON_WORDS, *PROSE_WORDS, *learned))
        self.cost = {w: math.log2(rank + 2) for rank, w in enumerate(ranked)}
        self.longest = max(map(len, self.cost))


PLAIN_DICTIONARY = Dictionary()


class Starts:
    """Places where a segment of growing length may have begun, each with its cost so far.

    A segment's cost grows with the logarithm of its length. If an earlier place is as cheap as a later
    one at some length, it stays so for all longer ones: the later place is dropped. If it is no cheaper
    to start with, it never is: the earlier place is dropped. So few are held.
    """

    def __init__(self):
        self.held: list[tuple[int, float]] = []

    def cheapest(self, end: int, shortest: int, unit: int) -> float:
        """Least cost of a segment that ends at ``end`` and has ``shortest`` characters at least."""
        least, kept = math.inf, []
        for at, cost in self.held:
            if end - at < shortest:
                kept.append((at, cost))
                continue
            here = cost + math.log2((end - at) // unit)
            if here < least:
                while kept and kept[-1][1] >= cost:
                    kept.pop()
                least = here
                kept.append((at, cost))
        self.held = kept
        return least


def guess_bits(value: str, words: Dictionary = PLAIN_DICTIONARY) -> float:
    """Bits of the cheapest segmentation, over all segmentations. Brute force costs the bits of each
    character; every other segment one bit for its kind and:

    - a word (of three letters or more) the logarithm of its rank, one bit more if it has capitals, two
      if look-alike characters are read as letters;
    - a date the logarithm of the number of dates;
    - a unit of one to four characters said twice or more: its characters, and the logarithm of the
      number of times;
    - a walk over three or more neighbouring keys: its first key and direction, the logarithm of its
      length, and a bit for each turn.

    best[j] is the least cost of value[:j]. Repeats and walks are extended from all their starts at once,
    so the work is linear in the length but for the words.
    """
    n = len(value)
    lower = value.lower()
    if len(lower) != n:  # some capitals have longer small forms
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = lower.translate(LEET)
    brute = [_character_bits(c) for c in value]
    upto = [0.0]
    for b in brute:
        upto.append(upto[-1] + b)
    best = [0.0] + [math.inf] * n
    run = [0] * (LONGEST_UNIT + 1)  # how many characters before here equal those one unit earlier
    repeats = [[Starts() for _ in range(unit)] for unit in range(LONGEST_UNIT + 1)]
    walks, cost = Starts(), words.cost
    near = [False] + [(lower[p - 1], lower[p]) in _neighbours for p in range(1, n)]
    turned = [0]  # turns at keys before each place: key p goes back to key p - 2
    for p in range(n):
        turned.append(turned[-1] + (p > 1 and near[p] and near[p - 1] and lower[p] == lower[p - 2]))
    for j in range(n + 1):
        if j:
            if best[j - 1] + brute[j - 1] < best[j]:
                best[j] = best[j - 1] + brute[j - 1]
            for unit in range(1, LONGEST_UNIT + 1):
                same = j > unit and value[j - 1] == value[j - 1 - unit]
                run[unit] = run[unit] + 1 if same else 0
                starts = repeats[unit][j % unit]
                if run[unit] >= unit:  # starts before the run are out of its reach
                    first = j - run[unit] - unit
                    if starts.held and starts.held[0][0] < first:
                        starts.held = [s for s in starts.held if s[0] >= first]
                    found = starts.cheapest(j, 2 * unit, unit) + 1 + upto[j] - upto[j - unit]
                    if found < best[j]:
                        best[j] = found
            if not near[j - 1]:  # the walk begins anew at the last key
                walks.held = [s for s in walks.held if s[0] >= j - 1]
            else:
                found = walks.cheapest(j, 3, 1) + turned[j] + 1 + math.log2(WALK_STARTS)
                if found < best[j]:
                    best[j] = found
        here = best[j]
        for k in range(j + 3, min(n, j + words.longest) + 1):
            for text, extra in ((lower[j:k], 0.0), (plain[j:k], 2.0)):
                if text in cost:
                    best[k] = min(best[k], here + 1 + cost[text] + extra + (value[j:k] != lower[j:k]))
        for pattern, days in _dates:
            found = pattern.match(value, j)
            if found:
                best[found.end()] = min(best[found.end()], here + 1 + math.log2(days))
        for unit in range(1, LONGEST_UNIT + 1):
            repeats[unit][j % unit].held.append((j, here))
        walks.held.append((j, here - turned[min(j + 2, n)]))  # turns count from the third key on
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, in order."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    if b"1" * HEX_LENGTH in text.encode().translate(_hex_bytes):
        found += [(m.start(), 2, m.end()) for m in _hex.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return sorted(found)


def guessed_spans(text: str, min_bits: float = MIN_BITS, words: Dictionary = PLAIN_DICTIONARY) -> list[tuple[int, int, int]]:
    """Values in a credential's context that cost at least ``min_bits``, whether or not a base span
    covers them too."""
    low = text.lower()
    if not any(hint in low for hint in CONTEXT_HINTS):
        return []
    found = []
    for m in _context.finditer(text):
        start, value = m.start(1), m[1].rstrip(".!?):]}")
        if guess_bits(value, words) >= min_bits:
            found.append((start, 3, start + len(value)))
    return found


def learned_words(docs: DataFrame, text_col: str = "text", limit: int = LEARNED_WORDS) -> list[str]:
    """The ``limit`` most frequent words of the corpus (letters a-z, 3 to 24 of them), most frequent
    first; counted per task before they are shuffled."""
    def counted(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                held.update(_learnable.findall((text.as_py() or "").lower()))
                if len(held) >= HELD_WORDS:
                    yield counted(held)
                    held.clear()
        if held:
            yield counted(held)

    words = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEARNED_COUNT)
    return [r["word"] for r in words.orderBy(F.col("n").desc(), "word").limit(limit).collect()]  # at most limit words


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_bits: float = MIN_BITS, dictionary_words: int = LEARNED_WORDS) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``found`` (array of kind, start, end; by start, then kind)."""
    docs = stable(docs)
    words = Dictionary(learned_words(docs, text_col, dictionary_words) if dictionary_words else ())
    source = with_row_id(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = sorted(base + guessed_spans(text or "", min_bits, words))
                rows.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("id"), pa.array(rows, span)],
                                             names=[ROW, "id", "found"])

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"{ROW} long, id {id_type}, found array<struct<kind:string,start:long,end:long>>")
