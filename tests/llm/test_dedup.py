"""SimHash classes, exact groups, repeated passages and repeated strings against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from newsloom.llm import anchors, golay, simhash, suffix_array, suffix_tree
from newsloom.llm.components import connected_components
from newsloom.llm.exact_dedup import drop_exact_copies, exact_groups
from tests.llm.conftest import doc_rows, texts_of


def lowered(raw: bytes) -> bytes:
    return raw.lower()


def brute_fingerprint(text):
    words = lowered((text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(items, linked):
    label = {k: k for k in items}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in items}


def test_golay_keys_reach_two_errors():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 300)
    near = golay.near_indices(words)
    assert set((near >= 0).sum(axis=1)) <= {1, 6}
    for errors in range(3):
        other = words.copy()
        for _ in range(errors):
            other ^= 1 << rng.integers(0, 23, len(words))
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(near, golay.near_indices(other)))


def test_fuzzy_keys_reach_three_errors():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    other = fps.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64)
    keys = set(zip(*(x.tolist() for x in simhash.fuzzy_keys(fps))))
    assert {r for r, k in zip(*(x.tolist() for x in simhash.fuzzy_keys(other))) if (r, k) in keys} == set(range(500))


@pytest.mark.parametrize("limit", [4096, 2])
def test_fingerprint_links_give_all_components(spark, save, limit):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist()[:10]:
        at = b
        for _ in range(12):  # chains of near fingerprints
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                at ^= 1 << int(bit)
            fps.add(at)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    table = save([(f,) for f in signed], "fp long")
    links = simhash.fingerprint_links(table, 3, bucket_limit=limit).collect()
    mask = (1 << 64) - 1
    assert all(((r["a"] ^ r["b"]) & mask).bit_count() <= 3 for r in links)
    pairs = {(r["a"], r["b"]) for r in links}
    found = brute_classes(signed, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    wanted = brute_classes(signed, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)
    assert found == wanted


def test_simhash_classes(docs, empty_docs):
    rows = texts_of(doc_rows())
    prints = [brute_fingerprint(t) for _, t in rows]
    classes = brute_classes(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for (i, _), fp in zip(rows, prints):
        least[classes[fp]].append(i)
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    wanted = Counter((i, fp, name[classes[fp]]) for (i, _), fp in zip(rows, prints))
    got = simhash.simhash_classes(docs).collect()
    assert Counter((r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got) == wanted
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(least)
    assert simhash.simhash_classes(empty_docs).count() == 0


def test_components_of_a_long_chain(save):
    links = save([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
    assert len({roots[i] for i in range(201)}) == 1 and roots[500] == roots[501] != roots[0]


def test_exact_groups(docs, empty_docs):
    rows = texts_of(doc_rows())
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t.encode())].append(i)
    got = exact_groups(docs).collect()
    assert len(got) == len(rows)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    wanted = Counter((i, best[lowered(t.encode())], len(groups[lowered(t.encode())])) for i, t in rows)
    assert Counter((r["id"], r["keep_id"], r["group_size"]) for r in got) == wanted
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_groups(empty_docs).count() == 0


def brute_cover(sequences, width):
    places = defaultdict(list)
    for d, s in enumerate(sequences):
        for i in range(len(s) - width + 1):
            places[tuple(s[i:i + width])].append((d, i))
    cover = [np.zeros(len(s), dtype=bool) for s in sequences]
    for where in places.values():
        if len(where) > 1:
            for d, i in where:
                cover[d][i:i + width] = True
    return cover


@pytest.mark.parametrize("options", [{}, {"anchor_limit": 1}, {"shard_bytes": 256}])
def test_repeated_passages(docs, empty_docs, options):
    rows = texts_of(doc_rows())
    sequences = [t.encode().split() for _, t in rows]
    for window, gram in ((35, 8), (6, 3))[bool(options):]:
        cover = brute_cover(sequences, window)
        wanted = Counter((i, len(s), int(c.sum()), b" ".join(w for w, x in zip(s, c) if not x).decode())
                         for (i, _), s, c in zip(rows, sequences, cover))
        got = suffix_tree.remove_passages(docs, window=window, gram=gram, **options).collect()
        assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == wanted
    assert suffix_tree.remove_passages(empty_docs).count() == 0


@pytest.mark.parametrize("options", [{}, {"anchor_limit": 1}, {"shard_bytes": 512}])
def test_repeated_strings(docs, empty_docs, options):
    rows = texts_of(doc_rows())
    sequences = [t.encode() for _, t in rows]
    for width, gram in ((200, 32), (30, 8))[bool(options):]:
        cover = brute_cover(sequences, width)
        wanted = Counter((i, len(s), int(c.sum()), hashlib.sha256(bytes(b for b, x in zip(s, c) if not x)).hexdigest())
                         for (i, _), s, c in zip(rows, sequences, cover))
        got = suffix_array.remove_strings(docs, width=width, gram=gram, **options).collect()
        assert Counter((r["id"], r["n_bytes"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest())
                       for r in got) == wanted
        for r in got:
            assert sum(b - a for a, b in r["spans"]) == r["n_removed"]
    assert suffix_array.remove_strings(empty_docs).count() == 0


@pytest.mark.parametrize("passages, strings", [({"anchor_limit": 1}, {"anchor_limit": 1}),
                                               ({"shard_bytes": 256}, {"shard_bytes": 512})])
def test_all_paths_at_production_widths(docs, passages, strings):
    rows = texts_of(doc_rows())
    sequences = [t.encode().split() for _, t in rows]
    got = suffix_tree.remove_passages(docs, **passages).collect()
    assert Counter((r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == Counter(
        (i, len(s), int(c.sum()), b" ".join(w for w, x in zip(s, c) if not x).decode())
        for (i, _), s, c in zip(rows, sequences, brute_cover(sequences, 35)))
    sequences = [t.encode() for _, t in rows]
    got = suffix_array.remove_strings(docs, **strings).collect()
    assert Counter((r["id"], r["n_bytes"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got) == Counter(
        (i, len(s), int(c.sum()), hashlib.sha256(bytes(b for b, x in zip(s, c) if not x)).hexdigest())
        for (i, _), s, c in zip(rows, sequences, brute_cover(sequences, 200)))


def test_suffix_array_is_sorted_with_true_common_prefixes():
    rng = random.Random(4)
    for _ in range(20):
        contexts = [bytes(rng.choices(b"ab\0", k=rng.randint(1, 60))) for _ in range(20)]
        lengths = np.array([len(c) for c in contexts])
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.uint16) + 1
        symbols[begins + lengths] = 0
        left = np.repeat(begins + lengths, lengths + 1) - np.arange(len(symbols))
        keys = suffix_array.packed_keys(symbols, left)
        order = suffix_array.suffix_array(keys, left)
        suffixes = [tuple(symbols[p:p + left[p]].tolist()) for p in order]
        assert suffixes == sorted(suffixes) and sorted(order.tolist()) == list(range(len(symbols)))
        prefixes = suffix_array.common_prefixes(keys, left, order, 25, lane=8)
        for a, b, n in zip(suffixes, suffixes[1:], prefixes[1:]):
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == min(same, 25)


def test_windows_meet_in_their_anchor():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 3, 4000).astype(np.uint8)
    lengths = np.array([1000, 7, 993, 2000])
    anchor, owner, lo, hi = anchors.winnow(values, lengths, 12, 4)
    begins = np.cumsum(lengths) - lengths
    seen, where = {}, set()
    for h, d, a, b in zip(anchor.tolist(), owner.tolist(), lo.tolist(), hi.tolist()):
        for p in range(a, b + 1):
            assert (d, p) not in where
            where.add((d, p))
            assert seen.setdefault(values[begins[d] + p:begins[d] + p + 12].tobytes(), h) == h
    assert len(where) == sum(max(0, n - 11) for n in lengths)


def test_grown_anchors_share_out_all_windows():
    from newsloom.llm import repeats
    rng = random.Random(12)
    for _ in range(300):
        width = rng.randint(2, 40)
        core = rng.randint(1, width - 1)
        windows = rng.randint(1, width - core + 1)
        # the anchor lies in every window
        core_at = rng.randint(windows - 1, width - core)
        parts, rounds = [(0, windows, core_at, core)], 0
        while any(c < width for _, _, _, c in parts):
            grown = []
            for lo, n, at, c in parts:
                if c == width:
                    grown.append((lo, n, at, c))
                    continue
                for first, count, place, longer in repeats.grow(width, n, at, c):
                    assert c < longer <= width and count - 1 <= place <= width - longer
                    grown.append((lo + first, count, place, longer))
            parts, rounds = sorted(grown), rounds + 1
            assert [w for lo, n, _, _ in parts for w in range(lo, lo + n)] == list(range(windows))
        assert all(n == 1 for _, n, _, _ in parts) and rounds <= 1 + (width - core).bit_length()


def test_scans_with_other_core_counts_agree(spark, save, monkeypatch):
    """Rows are told apart by file and place: another number of splits changes nothing."""
    from newsloom.llm import common, decontaminate, exact_dedup, mixing, simhash, warc
    rows = [(i, f"text {i % 40} of forty " * (3 + i % 5)) for i in range(600)]
    table = save(rows, "doc_id long, text string, source string".replace(", source string", ""), files=5)
    pages = save([(i, "http://x", f"<p>{i % 50}</p>") for i in range(400)], "page_id long, url string, html string", files=5)
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    turn = iter(range(10**6))

    def shaken(df, name, real=common.materialise):
        k = next(turn) % 3
        spark.conf.set(names[0], ["1", "12", "3"][k])
        spark.conf.set(names[1], ["128m", "4k", "64k"][k])
        spark.conf.set(names[2], "0")
        return real(df, name)

    for module in (common, exact_dedup, simhash, warc, decontaminate, mixing):
        monkeypatch.setattr(module, "materialise", shaken)
    try:
        kept = exact_dedup.drop_exact_copies(table).collect()
        assert len(kept) == len({r["text"] for r in kept}) == len({t for _, t in rows})
        near = simhash.drop_near_copies(table).collect()
        assert len({r["doc_id"] for r in near}) == len(near) > 0
        mixed = mixing.mix_sources(table.selectExpr("*", "'a' AS source"))
        assert sum(r["taken"] for r in mixed.collect()) == int(1.5 * sum(len(t.split()) for _, t in rows))
        records = warc.round_trip(pages).collect()
        assert sum(r["record_type"] == "response" for r in records) == 50 and len(records) == 400
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_no_helper_column_clashes(spark, save):
    from newsloom.llm import decontaminate, exact_dedup, langid, mixing, simhash
    names = ("_row _dropped _dedup_row _near_row _lang_row _bench_row _bad taken size epoch _size _taken_row _mix_row mix_epoch "
             "mix_words _path _base _at _values _in0 lang_pred id text_ key root fp gone").split()
    rows = [(i, f"word{i % 4} some text here", "en", "s", *[k] * len(names)) for i in range(8) for k in (i,)]
    table = save(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} long" for n in names))
    bench = save([("b", "nothing alike")], "item_id string, text string", files=1)
    for out in (exact_dedup.drop_exact_copies(table), simhash.drop_near_copies(table), langid.drop_unidentified(table),
                decontaminate.drop_contaminated(table, bench)):
        assert out.columns == table.columns
        assert all(r[n] == r["doc_id"] for r in out.collect() for n in names)
    once = mixing.mixed_documents(table)
    again = mixing.mixed_documents(once.drop("mix_words"))
    assert set(table.columns) <= set(again.columns) and again.count() > 0
