"""Row-wise operators: token counts, packing, licences, language, language-model scores."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.corpus import WORDS, documents, frame


def by_row(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def test_token_counts_equal_the_library(spark):
    from quillmill.llm.token_counts import count_tokens

    docs = documents()
    got = count_tokens(frame(spark, docs)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in docs:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 512)] += 1
    assert by_row(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert count_tokens(frame(spark, []).limit(0)).count() == 0


def test_packing_is_a_round_trip_without_gaps(spark):
    from quillmill.llm.packing import pack_documents

    docs = documents()
    got = pack_documents(frame(spark, docs), group_documents=20).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            want[(i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert by_row(got, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack_documents(frame(spark, []).limit(0)).count() == 0


def test_first_fit_decreasing_is_first_fit():
    from quillmill.llm.packing import first_fit_decreasing

    sizes = np.random.default_rng(3).integers(1, 2048, 400)
    bins, offsets = first_fit_decreasing(sizes, 2048)
    room: list[int] = []
    for i in np.argsort(-sizes, kind="stable"):
        b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if b == len(room):
            room.append(2048)
        assert bins[i] == b and offsets[i] == 2048 - room[b]
        room[b] -= sizes[i]


def test_license_base_columns_equal_brute_force(spark):
    from quillmill.llm.license_scan import scan_licenses

    texts = ["Released UNDER the MIT License. Licensed under CC BY-NC 4.0.", "Apache License, Version 2.0 and apache-license version_2", "cc/by\nnc cc by nc-nd", "permit license", None, "", "mit", "under the mit licenseé", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GNU General Public License, version 3, see the MIT license.", "İunder the mit license", "occ by nc"]
    docs = [(5000 + k, t) for k, t in enumerate(texts)] + documents() + [(3, "under the mit license " * 40)]
    got = scan_licenses(frame(spark, docs)).collect()
    phrases = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = Counter()
    for i, t in docs:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(lower))
        hits = [(k, label) for p, label in phrases for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in hits]
        want[(i, len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits})))] += 1
    assert by_row(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    first = {r.doc_id - 5000: r for r in got if r.doc_id is not None and r.doc_id >= 5000}
    assert first[8].labels == "gpl-3" and first[9].labels == "gpl-3,mit" and first[3].labels == ""
    assert first[2].labels == "cc-by-nc,cc-by-nc-nd"
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in got)
    assert scan_licenses(frame(spark, []).limit(0)).count() == 0


def test_license_rules_are_hundreds_of_signatures():
    from quillmill.llm.license_rules import SIGNATURES, WINDOW, build_rules, most_words
    from quillmill.llm.license_scan import GATE, SHORT_NAME

    rules = build_rules()
    assert sum(len(x) for _, _, x in SIGNATURES) > 350 and len({r.pattern for r in rules}) == len(rules)
    for r in rules:
        assert re.compile(r.pattern) and r.pattern.startswith(f"^{r.anchor}") and len(r.keyword) >= 3
        assert any(g in r.pattern for g in GATE) or re.search(SHORT_NAME, re.sub(r"\(\?:[^)]*\)\??|\[|\]|\?", "", r.pattern[1:])), r.pattern
    assert most_words("a (?:b |c d )?(?:[^ ]+ ){1,3}e") == 7 and WINDOW < 40


BODIES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the 'Software'), to deal in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    "bsd-4": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "zlib": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "gpl-3": "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "gpl-2": "Published under GNU GPL version 2.",
    "lgpl-2": "This is LGPL v2.1 code",
    "cc-by-sa": "CC BY-SA 4.0",
    "mpl-2": "MPL 2.0",
    "epl-1": "see EPL-1.0",
}


def test_license_matches_and_labels_equal_brute_force(spark):
    import random

    from quillmill.llm.license_rules import WINDOW, build_rules
    from quillmill.llm.license_scan import scan_licenses

    rng = random.Random(31)
    texts = [*BODIES.values(), "permission is here by", "SPDX-License-Identifier: ISC", "simple example replies", "licensed under the terms of the gnu lesser general public license, version 3 or the MIT License (MIT)"]
    loose = " ".join(BODIES.values()).split() + "the gnu license version 2 under apache mit spdx identifier bsd clause 3".split()
    texts += [" ".join(rng.choice(loose) for _ in range(rng.randint(1, 80))) for _ in range(60)] + [" ".join(BODIES.values()), "under the mit license " * 300]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, list(enumerate(texts)))).collect()}
    rules = build_rules()
    for k, t in enumerate(texts):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.lower())
        tried = []
        for at, w in enumerate(words):
            window = " ".join(words[at : at + WINDOW])
            for rank, r in enumerate(rules):
                if r.anchor == w and (m := re.match(r.pattern, window)):
                    tried.append((at, at + len(m[0].split()), r.label, r.priority, rank))
        near = defaultdict(list)
        for y in tried:
            near[y[0]].append(y)
        kept = [x for x in tried if not any(y[1] >= x[1] and (y[3] > x[3] or y[3] == x[3] and (y[1] - y[0] > x[1] - x[0] or y[1] - y[0] == x[1] - x[0] and y[4] < x[4])) for b in range(max(0, x[0] - WINDOW), x[0] + 1) for y in near[b])]
        assert Counter((m.begin, m.stop, m.label, m.priority, m.rank) for m in got[k].matches) == Counter(kept), t
        base = set(got[k].base_labels.split(",")) - {""}
        assert got[k].labels == ",".join(sorted(base | {x[2] for x in kept}))
        assert got[k].score == (1 if base else max((x[3] for x in kept), default=0) / 100)
    for k, label in enumerate(BODIES):
        assert got[k].labels.split(",") == [label], (label, got[k].labels)


def predicted_by_hand(model, text):
    """One n-gram at a time, in plain Python."""

    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ (x >> shift)) * factor) & ((1 << 64) - 1)
        return x ^ (x >> 31)

    points = [ord(c) for c in f" {text.lower()} "] + [32, 32]
    total, grams = np.zeros(len(model.bias)), 0
    for k in range(len(points) - 2):
        a, b, c = points[k : k + 3]
        for gram in (a | 1 << 63, a | b << 21 | 1 << 62, a | b << 21 | 1 << 62 | c << 42):
            total += model.embedding[mixed(gram) & (len(model.embedding) - 1)].astype(float) @ model.weight.astype(float)
            grams += 1
    logits = ((total / grams + model.bias) / model.temperature)[:-1]
    share = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
    return model.languages[int(share.argmax())], round(float(share.max()), 3)


def test_language_id_learns_and_rejects(spark):
    import random

    from quillmill.llm.language_id import filter_languages, fit, predict

    rng = random.Random(5)
    stems = {"aa": ["the", "ing", "with", "sh"], "bb": ["ñas", "ción", "llo", "el"], "cc": ["ung", "sch", "ß", "der"]}
    rows = []
    for k in range(400):
        lang = ("aa", "bb", "cc")[k % 3]
        text = " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 60)))
        rows.append((k, text, lang))
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 --- !", None), (1003, "x" * 200_000, None), (None, "the thing", "aa"), (0, rows[0][1], "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = fit(docs)
    got = predict(docs, model).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    unseen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}
    kept = {r.doc_id for r in filter_languages(docs, model).collect()}
    assert not kept & {1000, 1001, 1002} and len(kept & set(range(400))) >= 398
    alien = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(7)) + " " + " ".join("".join(rng.choice("абвгдежзиклмнопрст") for _ in range(6)) for _ in range(20)) for _ in range(20)]
    alien += [" ".join("".join(rng.choice("qxzjkvbwpfg") for _ in range(8)) for _ in range(25)) for _ in range(20)]
    strange = spark.createDataFrame([(2000 + k, t, None) for k, t in enumerate(alien)], "doc_id long, text string, lang string")
    assert filter_languages(strange, model).count() <= 4
    for r in got[:40]:  # by hand: the mean of the n-grams' rows, the softmax among the languages
        text = next(t for i, t, _ in rows if i == r.doc_id)
        if r.doc_id is not None and r.lang_pred != "und" and r.doc_id:
            assert (r.lang_pred, round(r.score, 3)) == predicted_by_hand(model, text)
    one = fit(docs.where("lang = 'aa'"))
    assert {r.lang_pred for r in predict(docs, one).collect()} == {"aa", "und"}
    empty = docs.limit(0)
    assert predict(empty, fit(empty)).count() == 0
    assert {r.lang_pred for r in predict(docs, fit(empty)).collect()} == {"und"}


def test_language_id_sample_is_drawn_from_labelled_rows(spark):
    from quillmill.llm.language_id import labelled_sample

    def training(ids):
        return [k for k in ids if zlib.crc32(str(k).encode()) % 5]

    sparse = [(k, f"text {k}", ("aa", "bb")[k % 2] if k < 60 else None) for k in range(6000)]
    docs = spark.createDataFrame(sparse, "doc_id long, text string, lang string").repartition(3)
    texts, labels = labelled_sample(docs, 200, 1000)
    assert sorted(texts) == sorted(f"text {k}" for k in training(range(60))) and set(labels) == {"aa", "bb"}
    long = [(k, f"start {'middle ' * 5000} end", "aa") for k in range(50)]
    texts, labels = labelled_sample(spark.createDataFrame(long, "doc_id long, text string, lang string"), 200, 1000)
    assert len(texts) == len(training(range(50))) and {len(t) for t in texts} == {250} and any(not t.startswith("start") for t in texts)
    uneven = [(k, f"text {k}", "rare" if k < 20 else "common") for k in range(6000)]
    docs = spark.createDataFrame(uneven, "doc_id long, text string, lang string").repartition(3)
    texts, labels = labelled_sample(docs, 200, 1000)
    assert {t for t, x in zip(texts, labels) if x == "rare"} == {f"text {k}" for k in training(range(20))}
    assert 100 < labels.count("common") and len(texts) <= 400


def test_lm_base_score_and_counts_equal_brute_force(spark):
    from quillmill.llm.lm_score import score_documents

    docs = documents()
    got = score_documents(frame(spark, docs)).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tokens(t):
        return [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower)), None]

    def out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1

    counts = Counter(w for i, t in docs if not out(i) for w in tokens(t))
    total, distinct = counts.total(), len(counts)
    want = Counter()
    for i, t in docs:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        want[(i, out(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    assert score_documents(frame(spark, []).limit(0)).count() == 0


def test_context_tree_is_a_distribution_and_equals_direct_weighting():
    from quillmill.llm import lm_score as lm

    texts = [" ".join(WORDS[k % 40 : k % 40 + 30]).encode() for k in range(60)]
    data, firsts, _ = lm.laid_out(texts)
    keys, n = lm.gram_counts(data, firsts)
    contexts, tables = [], []
    for d in range(3):
        ctx, byte = (keys >> 8) & ((1 << 8 * d) - 1), keys & 255
        found = np.unique(ctx) if d < 2 else np.unique(ctx)[::2]
        if d == 2:
            found = found[np.isin(found & 255, contexts[1]) & np.isin(found >> 8, contexts[1])]
        table = np.zeros((len(found), 256))
        inside = np.isin(ctx, found)
        np.add.at(table, (np.searchsorted(found, ctx[inside]), byte[inside]), n[inside])
        contexts.append(found)
        tables.append(table)
    machine = lm.ContextTree(contexts, tables).automaton()
    assert np.allclose((10.0 ** machine.log_p.astype(float)).sum(axis=1), 1, atol=1e-4)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(d, c, node, more=None):
        """Log block probability of the tree below a context, with one more decision on the way."""
        row = tables[d][np.searchsorted(contexts[d], c)]
        lo, hi = node, node + 1
        while lo < 256:
            lo, hi = lo * 2, hi * 2
        ones, zeros = row[(lo + hi) // 2 - 256 : hi - 256].sum(), row[lo - 256 : (lo + hi) // 2 - 256].sum()
        a, b = zeros + (more is not None and more[1] == 0), ones + (more is not None and more[1] == 1)
        if d == 2:
            return kt(a, b)
        kids = [k for k in contexts[d + 1] if k & ((1 << 8 * d) - 1) == c]
        path = more[0][d] if more is not None and len(more[0]) > d else None
        below, ra, rb = 0.0, a, b
        for k in kids:
            taken = more if path is not None and k >> 8 * d == path else None
            below += weighted(d + 1, k, node, taken)
            sub = tables[d + 1][np.searchsorted(contexts[d + 1], k)]
            ra -= sub[lo - 256 : (lo + hi) // 2 - 256].sum() + (taken is not None and more[1] == 0)
            rb -= sub[(lo + hi) // 2 - 256 : hi - 256].sum() + (taken is not None and more[1] == 1)
        return np.logaddexp(kt(a, b), below + kt(ra, rb)) - math.log(2)

    for c in contexts[2][::7].tolist():
        history = [c & 255, c >> 8]
        state = 1 + len(contexts[1]) + int(np.searchsorted(contexts[2], c))
        for byte in (97, 122, 200):
            want, node = 0.0, 1
            for bit in map(int, f"{byte:08b}"):
                want += weighted(0, 0, node, (history, bit)) - weighted(0, 0, node)
                node = 2 * node + bit
            assert abs(want / math.log(10) - machine.log_p[state, byte]) < 1e-3
    whole = lm.run_automaton(machine, texts, lane=64)
    assert np.allclose(whole, lm.run_automaton(machine, texts, lane=7), atol=1e-3)


def test_lm_score_uses_every_context(spark):
    """More contexts than any fixed bound: the scores equal the tree of all contexts, in memory."""
    import random

    from quillmill.llm import lm_score as lm

    rng = random.Random(8)
    docs = [(k, "".join(rng.choice("abcdefghijKLMNOP ") for _ in range(rng.randint(0, 400)))) for k in range(120)] + [(500, None), (501, "é unseen 漢字")]
    got = lm.score_documents(frame(spark, docs)).collect()
    training = [(t or "").encode().lower() for k, t in docs if zlib.crc32(str(k).encode()) % 5 != 1]
    data, firsts, _ = lm.laid_out(training)
    keys, n = lm.gram_counts(data, firsts)
    contexts, tables = [], []
    for d in range(lm.DEPTH + 1):
        ctx = (keys >> 8) & ((1 << 8 * d) - 1)
        found, at = np.unique(ctx, return_inverse=True)
        table = np.zeros((len(found), 256))
        np.add.at(table, (at, keys & 255), n)
        contexts.append(found)
        tables.append(table)
    assert len(contexts[-1]) > 12_000 and sum(map(len, contexts)) < 1 << 16
    want = lm.run_automaton(lm.ContextTree(contexts, tables).automaton(), [(t or "").encode().lower() for _, t in docs])
    by_id = {r.doc_id: r.score for r in got}
    assert len(got) == len(docs)
    for (k, t), w in zip(docs, want):
        assert abs(by_id[k] - w) < 1e-3 + 1e-5 * abs(w), (k, by_id[k], w)
