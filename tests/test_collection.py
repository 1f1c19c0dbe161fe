"""Collecting papers, reading runs, and the command line."""

import json

import pytest

from quillmill import cli
from quillmill.plans import collection
from quillmill.sources import paged, runs

RAW = paged.FEED


def test_feed_to_accepted(spark):
    raw = spark.createDataFrame([("http://arxiv.org/abs/2401.1v1", " A  title", "2024-01-01", None, "s", ["cs.AI"], "", None), ("http://arxiv.org/abs/2401.1v3", "A title", "2024-01-01", None, "s", ["cs.AI"], "p", "cc"), ("2401.2", "B", "2024", None, "", [], "", None), ("2401.3", "C", "2024", None, "", [], "", None)], RAW)
    entries = collection.feed_entries(raw)
    from pyspark.sql import functions as F

    latest = collection.latest_entries(entries.withColumn("at", F.monotonically_increasing_id()), "at")
    got = {r.arxiv_id: r for r in latest.collect()}
    assert set(got) == {"2401.1v3", "2401.2", "2401.3"} and got["2401.2"].pdf_url == "https://arxiv.org/pdf/2401.2.pdf"
    works = spark.createDataFrame([("2401.1", 0, "Other", 90), ("2401.1", 1, "a TITLE", 30), ("2401.1", 2, "A title", 40), ("2401.2", 0, "X", 20)], "arxiv_base_id string, position int, title string, cited_by_count long")
    enriched = collection.enriched_entries(latest.drop("at"), works)
    assert {r.arxiv_base_id: r.openalex.cited_by_count if r.openalex else None for r in enriched.collect()} == {"2401.1": 40, "2401.2": 20, "2401.3": None}
    assert [(r.arxiv_id, r.cited_by_count) for r in collection.accepted_entries(enriched).collect()] == [("2401.1v3", 40)]
    probed = collection.usable_pages(latest.drop("at"), lambda url: (200, "text/html") if url.endswith("1") else (404, ""), workers=2)
    assert {r.arxiv_base_id: r.usable for r in probed.collect()} == {"2401.1": True, "2401.2": False, "2401.3": False}


def test_works_keep_the_first_and_skip_the_seen(spark):
    from quillmill.plans.registry import WORK, WORKS

    rows = [(k, w) for k, w in enumerate([*WORKS, WORKS[0].replace("v3", "v9")])]
    from pyspark.sql import functions as F

    works = spark.createDataFrame(rows, "at int, raw string").select("at", F.from_json("raw", WORK).alias("w")).select("at", "w.*")
    seen = spark.createDataFrame([("2302.00022",)], "arxiv_base_id string")
    assert [r.arxiv_id for r in collection.accepted_works(works, seen, "at").collect()] == ["2301.00009v3"]
    grid = collection.comparison_grid(spark.createDataFrame([("a", "x", "train"), ("b", "y", "test")], "id string, source string, split string"), ["m", "n"], ["low", "high"], spark.createDataFrame([("a", "m", "low")], "id string, model string, effort string"))
    assert sorted((r.id, r.model, r.effort) for r in grid.collect()) == [("a", "m", "high"), ("a", "n", "high"), ("a", "n", "low")]


def test_training_runs(spark, tmp_path):
    for run, file, log in (("one", "a", [{"step": 50, "loss": 1.0}, {"step": 60, "loss": 9.0}, {"step": 50, "eval_loss": 2.0}]), ("one", "b", [{"step": 50, "eval_loss": 3.0, "epoch": 1.0}]), ("two", "a", [{"step": 100, "eval_loss": 4.0}])):
        at = tmp_path / "checkpoints" / run / file
        at.mkdir(parents=True)
        (at / "trainer_state.json").write_text(json.dumps({"log_history": log, "other": 1}))
    log = runs.training_log(spark, f"{tmp_path}/checkpoints")
    assert sorted((r.run, r.step, r.eval_loss, r.epoch) for r in runs.evaluation_points(log).collect()) == [("one", 50, 3.0, 1.0), ("two", 100, 4.0, 0.0)]
    assert [(r.run, r.step, r.train_loss) for r in runs.training_points(log).collect()] == [("one", 50, 1.0)]
    assert [r.series for r in runs.label_series(runs.evaluation_points(log), [("two", "step > 50", "late")]).collect()] == ["late"]
    at = tmp_path / "wandb/run-2024-abc-x1/files"
    at.mkdir(parents=True)
    (at / "wandb-summary.json").write_text('{"train/loss": 0.5, "train/global_step": 7, "_runtime": 7200}')
    (at / "config.yaml").write_text("a: 1\nrun_name: named\n")
    row = runs.run_summaries(spark, f"{tmp_path}/wandb").first()
    assert (row.run_id, row.name, row.global_step, row.runtime_hours, row.eval_loss) == ("x1", "named", 7, 2.0, None)


def test_model_folder(spark, tmp_path, capsys):
    (tmp_path / "config.json").write_text("{}")
    (tmp_path / "model-1.safetensors").write_bytes(b"12345")
    (tmp_path / "model.safetensors.index.json").write_text('{"weight_map": {"a": "model-1.safetensors", "b": "model-2.safetensors"}}')
    row = runs.model_inventory(spark, str(tmp_path)).first()
    assert (row.num_safetensors, row.total_safetensors_bytes, row.has_index, row.missing_files) == (1, 5, True, ["model-2.safetensors", "tokenizer_config.json"])
    assert cli.main(["inventory", str(tmp_path)]) == 0 and "model-2" in capsys.readouterr().out


def test_validate_and_evaluate_commands(spark, tmp_path, capsys):
    good = {"id": "1", "domain": "d", "split": "train", "messages": [{"role": r, "content": "x"} for r in ("system", "user", "assistant")]}
    (tmp_path / "train.jsonl").write_text(json.dumps(good) + "\n\n" + json.dumps({**good, "messages": []}) + "\n")
    (tmp_path / "errors.jsonl").write_text("not json\n")
    assert cli.main(["validate", str(tmp_path)]) == 1
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert list(said["files"].values()) == [2] and said["errors"][0]["line"] == 3
    (tmp_path / "pairs.jsonl").write_text(json.dumps({"id": "1", "prediction": "一二三四五", "reference": "一二三四五"}) + "\n")
    assert cli.main(["evaluate", f"{tmp_path}/pairs.jsonl"]) == 0 and json.loads(capsys.readouterr().out.strip().splitlines()[-1])["bleu"] > 99
    with pytest.raises(SystemExit):
        cli.main(["validate", f"{tmp_path}/none"])


def test_prepare_and_extract_commands(spark, tmp_path, capsys):
    spark.createDataFrame([("A normal English sentence.", "这是一个正常的中文句子。", 0.5), ("x", "y", None)], "en string, zh string, sco double").write.parquet(f"{tmp_path}/raw")
    assert cli.main(["prepare", f"{tmp_path}/raw", "--out", f"{tmp_path}/out"]) == 0
    assert spark.read.json(f"{tmp_path}/out/sft/train").count() == 1
    profile = spark.read.json(f"{tmp_path}/out/profile/train").first()
    assert profile.num_examples == 1 and profile.sample_ids == ["quickmt_train_0000000000"] and profile.domains.general == 1
    target = {"title": "标题一二三四", "abstract": "摘要的内容在这里。", "category": "工学"}
    for name, side in (("native", target), ("english", {"title": "A title", "abstract": "An abstract of some length.", "category": "Eng"})):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"doc_id": f"p{k}", **side}) for k in range(30)) + "\n")
    spark.createDataFrame([(f"A normal English sentence {k}.", "这是一个正常的中文句子。", 0.5) for k in range(20)], "en string, zh string, sco double").coalesce(1).write.parquet(f"{tmp_path}/held")
    args = ["prepare", f"{tmp_path}/raw", "--held-back", f"{tmp_path}/held", "--native", f"{tmp_path}/native.jsonl", "--english", f"{tmp_path}/english.jsonl", "--out", f"{tmp_path}/all", "--abstracts", "4"]
    capsys.readouterr()
    assert cli.main(args) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    import hashlib

    dealt = [int(hashlib.sha1(f"p{k}".encode()).hexdigest(), 16) % 100 for k in range(30)]
    assert counts == {"train": 5, "validation": 2 + sum(b < 10 for b in dealt), "test": 2 + sum(10 <= b < 20 for b in dealt)}
    ids = [r.id for r in spark.read.json(f"{tmp_path}/all/sft/train").collect()]
    assert set(ids) == {"quickmt_train_0000000000", *[f"p{k}" for k in range(30) if dealt[k] >= 20][:4]}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/2401.1.html").write_text("<section><h2>Intro</h2><p>" + "Some useful words in a sentence. " * 12 + "</p></section>")
    papers = [{"arxiv_id": f"2401.{k}v1", "arxiv_base_id": f"2401.{k}", "title": "T", "cited_by_count": 30} for k in (1, 2)]
    (tmp_path / "papers.jsonl").write_text("\n".join(map(json.dumps, papers)))
    assert cli.main(["extract", "--candidates", f"{tmp_path}/papers.jsonl", "--pages", f"{tmp_path}/pages", "--out", f"{tmp_path}/seg"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"processed": 1, "missing": 1}
    assert [r.id for r in spark.read.json(f"{tmp_path}/seg/segments").collect()] == ["2401.1v1_intro_0001"]


def test_requests_of_the_remote_sources():
    from quillmill.sources import requests

    asked = []

    def send(method, url, params):
        asked.append((method, url, params))
        if method == "HEAD":
            return (405, {}, "") if url.endswith("a") else (200, {"content-type": "text/html"}, "")
        if url == requests.WORKS_URL:
            return 200, {}, json.dumps({"results": [{"id": "w"}], "meta": {"next_cursor": "n"}})
        if url == requests.FEED_URL:
            return (503, {"retry-after": "7"}, "") if len([x for x in asked if x[1] == url]) == 1 else (200, {}, '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>i</id></entry></feed>')
        return 200, {"content-type": "application/pdf"}, ""

    waits = []
    assert requests.feed_page(send, ["cs.AI", "cs.CL"], 5, 10, waits.append)[0][0] == "i" and waits == [7.0]
    assert asked[0][2] == {"search_query": "cat:cs.AI OR cat:cs.CL", "start": "5", "max_results": "10", "sortBy": "submittedDate", "sortOrder": "descending"}
    assert requests.works_page(send, "c", 50, 30, "me@x") == ([('{"id": "w"}',)], "n")
    assert asked[-1][2] == {"filter": "locations.source.id:S4306400194,cited_by_count:>29,topics.field.id:fields/17", "sort": "publication_date:desc", "per-page": "50", "cursor": "c", "mailto": "me@x"}
    assert requests.found_works(send, "2401.1", "A title") == [("2401.1", 0, '{"id": "w"}')] and asked[-1][2] == {"search": "A title"}
    probe = requests.page_probe(send)
    assert probe("x/a") == (200, "application/pdf") and probe("x/b") == (200, "text/html") and [m for m, u, _ in asked if u == "x/a"] == ["HEAD", "GET"]
    with pytest.raises(paged.RemoteError) as error:
        requests.answered((429, {"retry-after": "soon"}, ""))
    assert (error.value.status, error.value.retry_after) == (429, 0.0)
    calls = iter([paged.RemoteError(404), "ok"])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert requests.any_status_retried(call, sleep=waits.append) == "ok"


def test_collection_stops_at_its_target_and_goes_on(spark, tmp_path):
    from quillmill.streaming.resume import collect_pages

    pages = {"*": ([("a", 1), ("b", 0)], "1"), "1": ([("a", 1), ("c", 1)], "2"), "2": ([("d", 1)], None)}
    asked, said = [], []

    def fetch(cursor):
        asked.append(cursor)
        return pages[cursor]

    def accept(page, seen):
        return page.where("good = 1").join(seen, "key", "left_anti")

    def run(target, most=100):
        return collect_pages(spark, fetch, "key string, good int", accept, f"{tmp_path}/c", "key", target, most, say=said.append)

    assert run(1)["accepted"] == 1 and asked == ["*"]
    assert run(2)["accepted"] == 2 and run(9, most=4)["seen"] == 4 and asked == ["*", "1"]
    assert run(9) == {"pages": 3, "cursor": None, "done": True, "seen": 5, "accepted": 3} == run(9) and asked == ["*", "1", "2"]
    assert [json.loads(x)["page_seen"] for x in said] == [2, 2, 1]
    assert sorted(r.key for r in spark.read.parquet(f"{tmp_path}/c/accepted").collect()) == ["a", "c", "d"]
