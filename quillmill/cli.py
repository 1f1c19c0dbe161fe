"""Command line: ``python -m quillmill.cli COMMAND ...`` runs a build or a check on a Spark session."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "id string, domain string, split string, messages array<struct<role: string, content: string>>"
SPLITS = ("train", "validation", "test")
ABSTRACT = "doc_id string, title string, abstract string, keywords array<string>, category string, category_eng string, discipline string, discipline_eng string"


def prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    """Training, validation and test examples with their chat records and profiles.

    Parallel files give the general part: those after the command the training pairs, ``--held-back``
    ones the other splits.  ``--native`` and ``--english`` are the two sides of the abstracts.
    """
    from quillmill.functions.text import listed_characters
    from quillmill.operators.chat import build_records
    from quillmill.operators.rows import with_ordinal
    from quillmill.operators.summaries import split_profile
    from quillmill.plans.stages import abstract_examples, evaluation_examples, general_examples, split_examples
    from quillmill.sources.files import read_jsonl_placed, read_parallel, shard_paths, write_jsonl

    characters = listed_characters(a.traditional) if a.traditional else None

    def numbered(paths: list[str]) -> DataFrame:
        return with_ordinal(read_parallel(spark, *paths), ["file", "row_index"])

    parts: dict[str, list[DataFrame]] = {s: [] for s in SPLITS}
    parts["train"].append(general_examples(numbered(shard_paths(a.inputs, a.shards)), "ordinal", "train", a.limit, characters=characters))
    if a.held_back:
        held = numbered(sorted(a.held_back))
        for split, size in (("validation", a.validation_size), ("test", a.test_size)):
            parts[split].append(evaluation_examples(held, "ordinal", {split: size}, characters=characters))
    if a.native:
        sides = [read_jsonl_placed(spark, path, ABSTRACT) for path in (a.native, a.english)]
        for split, size in zip(SPLITS, (a.abstracts, a.validation_size, a.test_size)):
            parts[split].append(abstract_examples(*sides, split, size, characters=characters))
    counts = {}
    for split in SPLITS:
        if parts[split]:
            examples = split_examples(parts[split])
            write_jsonl(examples.orderBy("part", "at").drop("part", "at"), f"{a.out}/intermediate/{split}")
            write_jsonl(build_records(examples.orderBy("part", "at")), f"{a.out}/sft/{split}")
            profile = split_profile(examples, split, ["part", "at"])
            write_jsonl(profile, f"{a.out}/profile/{split}")
            counts[split] = profile.first().num_examples
    print(json.dumps(counts))
    return 0


def collect(spark: SparkSession, a: argparse.Namespace) -> int:
    """Accepted papers from a paged source of works, up to a target; runs go on where the last one ended."""
    import importlib

    from quillmill.plans.collection import accepted_works
    from quillmill.plans.registry import WORK
    from quillmill.sources.requests import works_page
    from quillmill.streaming.resume import collect_pages

    module, _, name = a.transport.partition(":")
    send = getattr(importlib.import_module(module), name)

    def accept(page: DataFrame, seen: DataFrame) -> DataFrame:
        works = page.withColumn("at", F.monotonically_increasing_id()).select("at", F.from_json("raw", WORK).alias("w")).select("at", "w.*")
        return accepted_works(works, seen, "at", a.least_citations).drop("at")

    state = collect_pages(spark, lambda cursor: works_page(send, cursor, a.page_size, a.least_citations, a.mail), "raw string", accept, a.out, "arxiv_base_id", a.target, a.most)
    print(json.dumps(state))
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Counts and errors of the named split files; exit status 1 if there is an error."""
    from quillmill.operators.chat import record_error
    from quillmill.sources.files import exists, read_jsonl_numbered

    files = [p for p in (f"{a.folder}/{s}.jsonl" for s in SPLITS) if exists(spark, p)]
    if not files:
        raise SystemExit("no split file")
    parts: list[DataFrame] = [read_jsonl_numbered(spark, p, RECORD) for p in files]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    flat = rows.select("file", "line", "record.*").withColumn("error", record_error(["id", "domain", "split", "messages"])).cache()
    counts = {r.file: r.n for r in flat.groupBy("file").agg(F.count("*").alias("n")).collect()}
    errors = [r.asDict() for r in flat.where("error is not null").select("file", "line", "error").orderBy("file", "line").limit(a.most).collect()]
    print(json.dumps({"files": counts, "errors": errors}, ensure_ascii=False))
    return 1 if errors else 0


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    """Segments of accepted papers whose pages are in a folder."""
    from quillmill.plans.stages import paper_documents
    from quillmill.operators.segments import segment_documents
    from quillmill.sources.files import read_jsonl, read_pages, write_jsonl

    schema = "arxiv_id string, arxiv_base_id string, title string, submitted_at string, categories array<string>, cited_by_count bigint, html_url string, pdf_url string, source_url string, license string"
    documents = paper_documents(read_jsonl(spark, a.candidates, schema), read_pages(spark, a.pages)).cache()
    write_jsonl(segment_documents(documents.where("not missing"), a.least, a.target, a.most), f"{a.out}/segments")
    print(json.dumps(documents.agg(F.count(F.when(~F.col("missing"), 1)).alias("processed"), F.count(F.when(F.col("missing"), 1)).alias("missing")).first().asDict()))
    return 0


def evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Corpus BLEU of a file with predictions and references."""
    from quillmill.operators.bleu import corpus_bleu
    from quillmill.operators.rows import first_n
    from quillmill.sources.files import read_jsonl

    pairs = read_jsonl(spark, a.pairs, "id string, prediction string, reference string")
    print(json.dumps(corpus_bleu(first_n(pairs, a.limit, ["id"]) if a.limit else pairs).first().asDict()))
    return 0


def inventory(spark: SparkSession, a: argparse.Namespace) -> int:
    """Files of a model folder, and which are missing."""
    from quillmill.sources.runs import model_inventory

    print(json.dumps(model_inventory(spark, a.folder).first().asDict()))
    return 0


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="quillmill")
    commands = top.add_subparsers(dest="command", required=True)
    one = commands.add_parser("prepare", help=prepare.__doc__)
    one.add_argument("inputs", nargs="+")
    one.add_argument("--out", required=True)
    one.add_argument("--limit", type=int, default=1000)
    one.add_argument("--shards", type=int, default=1)
    one.add_argument("--held-back", nargs="*", default=[])
    for name in ("native", "english", "traditional"):
        one.add_argument(f"--{name}")
    for name in ("abstracts", "validation-size", "test-size"):
        one.add_argument(f"--{name}", type=int, default=1000)
    one.set_defaults(run=prepare)
    one = commands.add_parser("collect", help=collect.__doc__)
    one.add_argument("--transport", required=True, help="module:function that sends a request")
    one.add_argument("--out", required=True)
    one.add_argument("--mail")
    for name, value in (("target", 100), ("most", 10_000), ("page-size", 100), ("least-citations", 21)):
        one.add_argument(f"--{name}", type=int, default=value)
    one.set_defaults(run=collect)
    one = commands.add_parser("validate", help=validate.__doc__)
    one.add_argument("folder")
    one.add_argument("--most", type=int, default=1000)
    one.set_defaults(run=validate)
    one = commands.add_parser("extract", help=extract.__doc__)
    for name in ("candidates", "pages", "out"):
        one.add_argument(f"--{name}", required=True)
    for name, value in (("least", 180), ("target", 1400), ("most", 1800)):
        one.add_argument(f"--{name}", type=int, default=value)
    one.set_defaults(run=extract)
    one = commands.add_parser("evaluate", help=evaluate.__doc__)
    one.add_argument("pairs")
    one.add_argument("--limit", type=int)
    one.set_defaults(run=evaluate)
    one = commands.add_parser("inventory", help=inventory.__doc__)
    one.add_argument("folder")
    one.set_defaults(run=inventory)
    args = top.parse_args(argv)
    return args.run(SparkSession.builder.getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
