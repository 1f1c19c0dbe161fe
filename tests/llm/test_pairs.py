"""Operators that compare rows with each other, held against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from tests.llm.corpus import documents, frame, prose


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    from quillmill.llm.components import connected_components

    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (7, 9), (9, 7), (7, 9)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = Union()
    for a, b in edges:
        want.tie(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want.find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed_by_brute_force(texts, length):
    counts = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if counts[t[s : s + length]] > 1:
                gone[s : s + length] = True
        out.append(gone)
    return out


def runs(gone):
    return int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())


@pytest.mark.parametrize(("length", "slab_ranges"), [(400, 4096), (60, 4096), (60, 1)])
def test_suffix_dedup_is_exact(spark, length, slab_ranges):
    from quillmill.llm.suffix_dedup import dedup_suffixes

    docs = documents()
    got = dedup_suffixes(frame(spark, docs), length=length, slab_ranges=slab_ranges, slab_bytes=20_000).collect()
    texts = [(t or "").encode() for _, t in docs]
    want = Counter()
    for (i, _), t, gone in zip(docs, texts, removed_by_brute_force(texts, length)):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want[(i, len(t), int(gone.sum()), runs(gone), hashlib.sha256(kept).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    short = 7 * length // 10
    repeats = defaultdict(list)
    for r in got:
        repeats[r.doc_id].append(r.n_repeats)
    sure, possible = (removed_by_brute_force(texts, n) for n in (short, short // 2))
    for (i, _), least, most in zip(docs, sure, possible):
        assert not least.any() or max(repeats[i]) > 0
        assert most.any() or min(repeats[i]) == 0
    assert dedup_suffixes(frame(spark, []).limit(0)).count() == 0


def test_long_documents_go_in_sections(monkeypatch):
    from quillmill.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SECTION", 1500)
    text = prose(random.Random(4), 2000).encode()
    number, first, count, _, _ = suffix_dedup.AnchorFinder(400, 200, 400).ranges([text, b"", text[:399], text[:400]])
    own = sorted((f, f + c) for n, f, c in zip(number, first, count) if n == 0 and c)
    assert own[0][0] == 0 and own[-1][1] == len(text) - 399 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert [(int(f), int(c)) for n, f, c in zip(number, first, count) if n == 3] == [(0, 1)]


def test_bucket_pointers_tell_strings_apart():
    from quillmill.llm.suffix_dedup import refine_buckets

    data = np.frombuffer(b"abcabcabd" * 30 + b"aaaaaaaaaaaaaaaaaaaaaaaa" + bytes(random.Random(1).choices(b"ab", k=300)), np.uint8)
    for depth in (8, 13, 40):
        pointer, raw = refine_buckets(data, depth), data.tobytes()
        inside = range(len(raw) - depth + 1)
        by = defaultdict(set)
        for i in inside:
            by[pointer[i]].add(raw[i : i + depth])
        assert all(len(v) == 1 for v in by.values()) and len(by) == len({raw[i : i + depth] for i in inside})


def cut_by_brute_force(rows, min_run=96):
    """The rule of substring dedup, one row and one pair of chunks at a time; chunk ends are the operator's."""
    from quillmill.llm.substring_dedup import chunk_batch, gear_table

    def signed(t):
        return xxhash_of_spark(t.encode())

    order = sorted(range(len(rows)), key=lambda k: (-(1 << 63) if rows[k][0] is None else rows[k][0], signed(rows[k][1] or ""), k))
    seen, out, done = set(), [None] * len(rows), set()
    for k in order:
        data = (rows[k][1] or "").encode()
        _, offsets, lengths, digests = chunk_batch([data], gear_table(), 2, 16, 160)
        if rows[k] in done:
            spans = [(0, len(data))]
        else:
            spans = []
            for a, n, d in zip(offsets.tolist(), lengths.tolist(), map(tuple, digests.tolist())):
                if d in seen:
                    if spans and a < spans[-1][1]:
                        spans[-1] = (spans[-1][0], a + n)
                    else:
                        spans.append((a, a + n))
                seen.add(d)
            done.add(rows[k])
        spans = [(a, b) for a, b in spans if b - a >= min_run]
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        out[k] = (rows[k][0], None if rows[k][1] is None else (kept + data[at:]).decode(), len(spans))
    return out


def xxhash_of_spark(data):
    """Spark's xxhash64 of a string, seed 42, as a signed number."""
    import xxhash

    value = xxhash.xxh64_intdigest(data, 42)
    return value - (1 << 64) if value >= 1 << 63 else value


def test_substring_dedup_cuts_later_copies_only(spark):
    from quillmill.llm.substring_dedup import cut_repeats, dedup_substrings

    rng = random.Random(9)
    passage = prose(rng, 80)
    rows = [(k, f"{prose(rng, 50 + k)} {passage} {prose(rng, 60)}" if k % 3 == 0 else prose(rng, 120)) for k in range(30)]
    rows += [(100, rows[1][1]), (101, "short text"), (102, "short text"), (103, None), (104, ""), (105, "z" * 5000), (None, prose(rng, 40))]
    got = {r.doc_id: r for r in dedup_substrings(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and got[103].text is None and got[104].text == ""
    for i, t in rows:
        r = got[i]
        assert r.n_bytes == len((t or "").encode()) and r.n_bytes - r.n_removed == len((r.text or "").encode())
        assert r.kept_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert got[0].n_removed == 0 and passage in got[0].text
    assert all(got[k].n_removed >= 0.7 * len(passage) and got[k].n_removed <= len(passage) for k in range(3, 30, 3))
    assert all(got[k].n_removed == 0 for k in range(30) if k % 3) and got[100].text == "" and got[102].text == "short text"
    assert Counter((i, r.text, r.n_spans) for i, r in got.items()) == Counter(cut_by_brute_force(rows))
    table = cut_repeats(frame(spark, rows))
    assert table.columns == frame(spark, rows).columns
    assert {r.doc_id: r.text for r in table.collect()} == {i: r.text for i, r in got.items()}
    assert all(r.n_chars == len(r.text or "") for r in table.collect())
    assert dedup_substrings(frame(spark, []).limit(0)).count() == 0


def test_substring_dedup_equals_brute_force_where_ids_are_shared(spark):
    from quillmill.llm.substring_dedup import cut_repeats, dedup_substrings

    rng = random.Random(10)
    passage, other = prose(rng, 60), prose(rng, 70)
    rows = documents(n=40)
    rows += [(7777, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for _ in range(4)] + [(None, f"{prose(rng, 20)} {other} {prose(rng, 9)}") for _ in range(3)]
    rows += [(8888, f"{passage} {other}")] * 5 + [(None, f"{other} {passage}")] * 4
    want = Counter(cut_by_brute_force(rows))
    assert Counter((r.doc_id, r.text, r.n_spans) for r in dedup_substrings(frame(spark, rows)).collect()) == want
    assert Counter((r.doc_id, r.text) for r in cut_repeats(frame(spark, rows)).collect()) == Counter(x for i, t, n in want.elements() for x in [(i, t)])
    whole = [t for i, t, _ in want.elements() if t and passage in t]
    assert len(whole) == 1 and sum(1 for i, t, _ in want.elements() if i == 8888 and t == "") >= 4


def test_chunk_ends_resist_insertions():
    from quillmill.llm.substring_dedup import chunk_batch, gear_hash, gear_table

    table, text = gear_table(), prose(random.Random(3), 3000)
    data, h = np.frombuffer(text.encode(), np.uint8), 0
    for b, fast in zip(data.tolist(), gear_hash(data, table).tolist()):
        h = ((h << 1) + int(table[b])) & 0xFFFF
        assert h == fast
    moved = text[:5000] + " inserted words" + text[5000:]
    (_, _, _, one), (_, _, _, two) = (chunk_batch([t.encode()], table, 2, 16, 512) for t in (text, moved))
    missing = set(one[:, 0].tolist()) - set(two[:, 0].tolist())
    assert len(missing) <= 4


def sets_of(docs):
    out = []
    for _, t in docs:
        words = (t or "").encode().lower().split()
        out.append(frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset())
    return out


@pytest.mark.parametrize("few", [64, 2])
def test_jaccard_join_is_exact(spark, few):
    from quillmill.llm.jaccard_join import jaccard_components, keep_one_of_each

    rng = random.Random(6)
    base = prose(rng, 200).split()
    docs = documents()
    for k in range(40):  # a chain and a star of near copies
        words = list(base)
        for _ in range(k % 12):
            words[rng.randrange(len(words))] = f"edit{k}"
        docs.append((3000 + k, " ".join(words)))
    sets, union = sets_of(docs), Union()
    for a in range(len(docs)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                union.tie(a, b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None and sets[k]:
            least[union.find(k)] = min(i, least.get(union.find(k), i))
    want = Counter((i, len(sets[k]), least.get(union.find(k)) if sets[k] else i) for k, (i, _) in enumerate(docs))
    got = jaccard_components(frame(spark, docs), few=few, task_postings=500 if few == 2 else 2_000_000, in_all=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    kept = Counter(r.doc_id for r in keep_one_of_each(frame(spark, docs)).collect())
    one, wordless = {}, [i for k, (i, _) in enumerate(docs) if not sets[k]]
    for k, (i, _) in enumerate(docs):
        if sets[k]:
            one[union.find(k)] = min((i is None, i or 0), one.get(union.find(k), (True, 1 << 62)))
    assert kept == Counter(wordless) + Counter(None if none else i for none, i in one.values())
    assert jaccard_components(frame(spark, []).limit(0)).count() == 0
    assert keep_one_of_each(frame(spark, []).limit(0)).count() == 0


def test_t_occurrence_search_finds_all():
    from quillmill.llm.jaccard_join import InvertedIndex

    rng = np.random.default_rng(8)
    common = rng.integers(0, 2**63, 30).astype(np.uint64)
    sets = []
    for k in range(150):
        own = rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64)
        if k % 3 == 0 and sets:
            own = np.concatenate([sets[rng.integers(len(sets))][: rng.integers(1, 90)], own[:3]])
        sets.append(np.unique(np.concatenate([own, common[: rng.integers(0, 30)]])))
    index, sizes, free = InvertedIndex(sets, np.arange(150)), np.array([len(s) for s in sets]), np.ones(150, bool)
    for k, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))]
        for mu in (0.0085, 1e-6, 10):
            assert sorted(index.search(s, sizes, free, mu).tolist()) == want, k


def test_decontamination_tolerates_substitutions(spark, monkeypatch):
    from quillmill.llm import decontaminate

    rng = random.Random(12)
    items = [(k, prose(rng, 12 + 4 * k)) for k in range(8)] + [(8, None), (9, ""), (10, "two words"), (11, prose(rng, 30))]
    items.append((12, items[11][1]))
    items += [(20 + n, " ".join(f"q{n}w{k}" for k in range(n))) for n in range(1, 7)] + [(30, prose(rng, 60))]
    docs = documents()
    for k, t in items[13:-1]:  # short ones verbatim, and with each word changed
        words = t.split()
        docs += [(6000 + 20 * k + at, " ".join(["before", *words[:at], "substitute", *words[at + 1 :], "after"])) for at in range(len(words))]
        docs.append((6000 + 20 * k + 19, f"before {t} after"))
    long = items[-1][1].split()
    docs += [(8000, " ".join(long[:44])), (8001, " ".join([*long[:28], "inserted", *long[28:]])), (8002, f"{prose(rng, 9)} {' '.join(long[20:])}"), (8003, " ".join(long[:19]))]
    for k, t in items[:8]:
        for changes in (0, len(t.split()) // 5, len(t.split()) // 2):
            words = t.split()
            for at in rng.sample(range(len(words)), changes):
                words[at] = "substitute"
            docs.append((4000 + 10 * k + (0, 1, 2)[(changes > 0) + (changes > len(words) // 5)], f"{prose(rng, 20)} {' '.join(words).upper()}! {prose(rng, 5)}"))
    docs.append((5000, f"{items[11][1]} {items[11][1]}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    import re

    def words_of(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())

    docs += [(None, items[11][1]), (8100, items[11][1]), (8100, "clean text under the same id")]
    want, leaked = set(), {(8100, items[11][1]), (None, items[11][1])}
    for i, t in docs:
        w = words_of(t)
        for item, x in items:
            v = words_of(x)
            for start in range(-len(v) + 1, len(w)) if v else ():
                same = [0 <= start + k < len(w) and w[start + k] == v[k] for k in range(len(v))]
                if sum(same) >= 0.8 * len(v) or any(sum(same[k : k + 25]) >= 20 for k in range(len(v) - 24)):
                    want.add((i, item, start, sum(same), len(v)))
    for limit in (64 << 20, 0):
        got = decontaminate.contaminations(frame(spark, docs), bench, broadcast_bytes=limit).collect()
        assert {(r.doc_id, r.item_id, r.start, r.n_equal, r.item_size) for r in got} == want and len(got) == len(want)
    hit = {i for i, *_ in want}
    assert {8000, 8001, 8002} <= hit and not {i for i, item, *_ in want if item == 30} - {8000, 8001, 8002}
    assert all(6000 + 20 * k + 19 in hit for k, _ in items[13:-1])
    assert all({6000 + 20 * (20 + n) + at for at in range(n)} <= hit for n in (5, 6))
    assert {4000 + 10 * k for k in range(8)} | {4001 + 10 * k for k in range(8)} <= hit and not {4002 + 10 * k for k in range(8)} & hit
    kept = Counter((r.doc_id, r.text) for r in decontaminate.drop_contaminated(frame(spark, docs), bench).collect())
    assert kept == Counter((i, t) for i, t in docs if (i not in hit or i in (None, 8100)) and (i, t) not in leaked)
    assert decontaminate.drop_contaminated(frame(spark, []).limit(0), bench).count() == 0
    assert decontaminate.contaminations(frame(spark, []).limit(0), bench).count() == 0
    assert decontaminate.contaminations(frame(spark, docs), bench.limit(0)).count() == 0


def vectors(seed=0, dim=48):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(260):
        v = rng.normal(size=dim)
        if k % 4 == 0 and rows:
            old = np.array(rows[rng.integers(len(rows))][1])
            v = old + rng.normal(size=dim) * np.linalg.norm(old) / np.sqrt(dim) * rng.choice([0, 0.1, 0.3, 0.38, 0.42, 0.6])
        rows.append((3 * k + 1, [float(x) for x in np.float32(v)], int(rng.integers(0, 2))))
    centre = rng.normal(size=dim)
    rows += [(2000 + k, [float(x) for x in np.float32(centre + rng.normal(size=dim) * 0.2)], 1) for k in range(60)]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * dim, 1), (5003, [None] + [1.0] * (dim - 1), 1), (5004, [float("nan")] + [1.0] * (dim - 1), 1), (5005, [float("inf")] + [1.0] * (dim - 1), 1)]
    rows += [(5006, rows[0][1], None), (5007, rows[0][1][:7], rows[0][2]), (5008, rows[0][1], rows[0][2]), (5009, rows[0][1], 1 - rows[0][2]), rows[0], (5010, [2 * x for x in rows[0][1]], rows[0][2])]
    return rows


@pytest.mark.parametrize(("part_rows", "cell_rows", "dim", "margin"), [(3000, 1500, 48, None), (40, 10, 48, None), (40, 10, 48, 21.6), (3000, 6, 8, None)])
def test_embedding_links_equal_brute_force(spark, part_rows, cell_rows, dim, margin):
    from quillmill.llm.embedding_dedup import near_duplicates

    rows = vectors(dim=dim)
    schema = "vec_id long, embedding array<float>, label int, node long, weight string"
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], schema).repartition(3)
    got = near_duplicates(table, part_rows=part_rows, cell_rows=cell_rows, margin=margin).collect()
    usable = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, union = Counter(), Union()
    for a in usable:
        for b in usable:
            if b < a and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float64), np.array(rows[b][1], np.float64)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    union.tie(a, b)
    least = {}
    for k in usable:
        least[union.find(k)] = min(rows[k][0], least.get(union.find(k), rows[k][0]))
    want = Counter((r[0], links[k], least.get(union.find(k), r[0]) if k in usable else r[0]) for k, r in enumerate(rows))
    found = Counter((r.vec_id, r.n_links, r.component_id) for r in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    if cell_rows == 1500 or margin is not None:  # one cell, or a margin that makes sure
        assert found == want
    else:  # several cells: recall of links, none invented
        by_id = defaultdict(list)
        for (i, n, _), m in want.items():
            by_id[i] += [n] * m
        assert sum(r.n_links for r in got) >= 0.97 * sum(links.values()) and all(r.n_links <= max(by_id[r.vec_id]) for r in got)
    if dim == 48 and margin is None:
        assert near_duplicates(table.limit(0)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    from quillmill.llm.embedding_dedup import encode, estimate, normalized, rotation

    rng = np.random.default_rng(1)
    unit, queries, dim = normalized(rng.normal(size=(400, 64))), normalized(rng.normal(size=(300, 64))), 64
    turn = rotation(dim)
    assert np.allclose(turn @ turn.T, np.eye(dim), atol=1e-9)
    values, bounds = estimate(*encode(unit, turn), queries @ turn, 4.5)
    error = values - unit @ queries.T
    assert abs(error.mean()) < 2e-3 and (np.abs(error) <= bounds[:, None]).mean() > 0.9999


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(20)
    passage, leak = prose(rng, 80), prose(rng, 30)
    texts = [prose(rng, 150) for _ in range(40)]
    texts += [f"{prose(rng, 70)} {passage} {prose(rng, 70)}" for _ in range(5)] + [f"{prose(rng, 60)} {leak} {prose(rng, 60)}"]
    texts += [texts[0], texts[1].replace(texts[1].split()[10], "other", 1), "123 456", None]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        seen.append({r.doc_id: r.text for r in docs.collect()})
    assert set(range(48)) >= set(seen[0]) >= set(range(40)) and not {48, 49} & set(seen[0])
    assert set(seen[0]) - set(seen[1]) == {46, 47}
    assert sum(passage in (t or "") for t in seen[2].values()) == 1
    assert set(seen[2]) - set(seen[3]) == {45}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(seen[3])


def test_jaccard_join_keeps_other_texts_out_of_the_shuffle(spark, monkeypatch):
    from quillmill.llm import jaccard_join
    from quillmill.llm.common import with_text_key

    rng = random.Random(11)
    docs = documents() + [(5000 + k, prose(rng, 30)) for k in range(400)]
    keyed = with_text_key(frame(spark, docs))
    wanted = keyed.where("did % 40 = 0 or did < 0").select("did", "rh").distinct()
    keys = {tuple(r) for r in wanted.collect()}
    for most_bits in (24, 6):  # a full bitmap lets others pass, too
        got = [(r.did, r.rh) for r in jaccard_join.likely_rows(keyed, wanted, len(keys), most_bits).collect()]
        assert Counter(x for x in got if x in keys) == Counter((r.did, r.rh) for r in keyed.collect() if (r.did, r.rh) in keys)
        assert most_bits == 6 or len([x for x in got if x not in keys]) < 0.15 * len(docs)
    want = Counter(map(tuple, jaccard_join.jaccard_components(frame(spark, docs)).select("doc_id", "component_id").collect()))
    asked = []
    monkeypatch.setattr(jaccard_join, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(jaccard_join, "likely_rows", lambda *a, real=jaccard_join.likely_rows: asked.append(1) or real(*a))
    got = Counter(map(tuple, jaccard_join.jaccard_components(frame(spark, docs)).select("doc_id", "component_id").collect()))
    assert asked and got == want


def test_jaccard_join_deletes_the_prefixes_of_all_copies(spark):
    from quillmill.llm.jaccard_join import linked_rows

    out = linked_rows(frame(spark, documents()))
    assert "prefix" not in out.reads[0].columns and out.count() == len(documents())


def test_written_tables_go_with_the_next_stage(spark, tmp_path):
    import corpus_pipeline
    from quillmill.llm.jaccard_join import keep_one_of_each
    from quillmill.sources.durable import checkpoint_dir

    def tables():
        return {p.name for p in Path(checkpoint_dir(spark).removeprefix("file://"), "quillmill").glob("*")}

    before = tables()
    kept = keep_one_of_each(frame(spark, documents()))
    assert {x.rsplit("-", 1)[0] for x in tables() - before} <= {"jaccard-gone"} and kept.count()
    before, rng = tables(), random.Random(21)
    rows = [(k, prose(rng, 120), "en", "s", 1) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    left = {x.rsplit("-", 1)[0] for x in tables() - before}
    assert {x for x in left if x.startswith("pipeline-") or x in ("accepted", "without-repeats")} == {"pipeline-benchmark_decontamination"}
    assert pieces.count() >= 30
