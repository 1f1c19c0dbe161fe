"""Every registered query against its SQL oracle, on the smallest tables."""

import hashlib
import html
import math
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from quillmill.operators import segments
from quillmill.plans import registry
from tests.test_operators import fold

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(rows):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(one, r)) for r in rows)


def documents(oracle):
    return oracle.execute("SELECT doc_id, text, source FROM documents").fetchall()


def packed_sentences(oracle):
    for i, t, _ in documents(oracle):
        yield from ({"doc_id": i, "place": k, "chunk": c} for k, c in enumerate(fold(t or "", 400)))


def segment_rows(oracle, least=180, target=1400, most=1800):
    """Paragraphs gathered one after the other; what holds formulas is cut by the operator's own function."""
    for i, t, _ in documents(oracle):
        out, held = [], ""
        for p in (t or "").split("\n"):
            p = segments.fenced(p) if "$" in p else " ".join(p.split())
            if not p:
                continue
            if held and (len(p) > most or len(held) + 2 + len(p) > target):
                out.append(held)
                held = ""
            if len(p) > most:
                out += [c for c in (segments.split_long(p, most) if "$" in p else fold(p, most)) if len(c) >= least]
            else:
                held = f"{held}\n\n{p}" if held else p
        if len(held) >= least:
            out.append(held)
        paper = f"2401.{i:05d}"
        bucket = int(hashlib.sha1(paper.encode()).hexdigest(), 16) % 100
        for k, c in enumerate(out, 1):
            yield {"id": f"{paper}v1_introduction_{k:04d}", "source": c, "split": "validation" if bucket < 5 else "test" if bucket < 10 else "train", "section": "introduction", "paper_id": f"{paper}v1"}


def bleu_pairs(oracle):
    texts = {i: t for i, t, _ in documents(oracle)}
    for i, reference in oracle.execute("SELECT item_id, text FROM benchmark").fetchall():
        if i in texts:
            yield i, texts[i], reference
        yield -i - 1, reference, reference


def bleu_tokens(text):
    """The published rules: punctuation apart, but not points and commas between digits."""
    out = re.sub(r"([{-~\[-` -&(-+:-@/])", r" \1 ", (text or "").strip())
    out = re.sub(r"([^0-9])([.,])", r"\1 \2 ", out)
    out = re.sub(r"([.,])([^0-9])", r" \1 \2", out)
    return re.sub(r"([0-9])(-)", r"\1 \2 ", out).split()


def bleu_sums(prediction, reference):
    p, r = bleu_tokens(prediction), bleu_tokens(reference)
    grams = [[Counter(tuple(x[k : k + n]) for k in range(len(x) - n + 1)) for x in (p, r)] for n in range(1, 5)]
    return [len(p), len(r), *(sum(min(c, b[g]) for g, c in a.items()) for a, b in grams), *(max(len(p) - n, 0) for n in range(4))]


def bleu_score(sums):
    mine, theirs, met, all_ = sums[0], sums[1], sums[2:6], sums[6:]
    if not mine or not all_[3] or not met[0]:
        return 0.0
    logs, smooth = 0.0, 1.0
    for m, n in zip(met, all_):
        if m == 0:
            smooth *= 2
        logs += math.log(100 * m / n if m else 100 / (smooth * n))
    return min(1.0, math.exp(1 - theirs / mine) if mine < theirs else 1.0) * math.exp(logs / 4)


def bleu_rows(oracle):
    for i, p, r in bleu_pairs(oracle):
        yield {"item_id": i, "bleu": bleu_score(bleu_sums(p, r)), "length_ratio": len(p) / max(len(r), 1)}


def bleu_corpus(oracle):
    every = [bleu_sums(p, r) for _, p, r in bleu_pairs(oracle)]
    sums = [sum(x) for x in zip(*every)]
    yield {"bleu": bleu_score(sums), "n_pairs": len(every), "sys_len": sums[0], "ref_len": sums[1]}


BRUTE_FORCE = {"q_pack_sentences": packed_sentences, "q_segments": segment_rows, "q_bleu_rows": bleu_rows, "q_bleu_corpus": bleu_corpus}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    if name in registry.ORACLE_SQL:
        want = oracle.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
        assert plain(got) == plain(want)
    if name in BRUTE_FORCE:
        want = [tuple(r[c] for c in columns) for r in BRUTE_FORCE[name](oracle)]
        assert plain(got) == plain(want) and got
    assert name in registry.ORACLE_SQL or name in BRUTE_FORCE
    if name == "q_html_documents":
        pages = dict(oracle.execute("SELECT page_id, html FROM pages").fetchall())
        assert sorted(r.page_id for r in df.collect()) == sorted(pages)
        for r in df.collect():
            words = " ".join(re.sub("<[^>]*>", " ", html.unescape(pages[r.page_id])).split())
            removed = dict(x.split("=") for x in r.removed.split(","))
            assert (r.title or "") in words and r.n_sections >= 0
            assert int(removed["scripts"]) == len(re.findall(r"(?i)<(?:script|style|noscript)[\s>]", pages[r.page_id]))
