"""License scans: ordered signature rules over whole texts, in DataFrame functions only.

A gate of plain substring tests lets few documents through to the rules.  There, anchor words select
the rules that can start at them, a rule's keyword spares most regexes, and each match is an interval
of words with a label and a priority.  A match that lies within one of at least its priority is
suppressed, equal intervals leaving the first rule's; as no match is longer than the window, only
matches from the last places are compared, so the work grows with the text, not with its square.  The
scan is map-only: no exchange, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.license_rules import BASE_PHRASES, WINDOW, Rule, build_rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Every signature and base phrase holds one of these, or a short name before a number, or "cc by".
GATE = ("licen", "spdx", "gpl", "cc0", "apache", "bsd", "wtfpl", "commons", "hereby", "distribut", "unencumbered", "misrepresent", "copyright", "warrant", "domain", "openssl", "mozilla", "mulan", "endorse", "cddl", "cecill", "jpeg", "advertising")
SHORT_NAMES = ("cc", "mpl", "epl", "asl", "ofl", "eupl")
SHORT_NAME = r"(?<![a-z0-9\x80-\uffff])(?:cc|mpl|epl|asl|ofl|eupl)[\x00-\x2F\x3A-\x60\x7B-\x7F]+(?:by|zero|v?[\x00-\x2F\x3A-\x60\x7B-\x7F]*[0-9])"


def quoted(text: str) -> str:
    return "r'" + text + "'"


def gate(lowered: Column) -> Column:
    """Whether a lower-cased text can hold a phrase at all."""
    some, short = F.lit(False), F.lit(False)
    for word in GATE:
        some = some | lowered.contains(word)
    for word in SHORT_NAMES:
        short = short | lowered.contains(word)
    return some | (short & lowered.rlike(SHORT_NAME))


def rule_table(rules: list[Rule]) -> str:
    """SQL map from an anchor to its rules; its size is fixed by the rule set."""
    by_anchor: dict[str, list[str]] = {}
    for k, r in enumerate(rules):
        by_anchor.setdefault(r.anchor, []).append(f"named_struct('keyword', '{r.keyword}', 'pattern', {quoted(r.pattern)}, 'label', '{r.label}', 'priority', {r.priority}, 'rank', {k})")
    return f"map_from_arrays(array({', '.join(map(repr, by_anchor))}), array({', '.join(f'array({", ".join(x)})' for x in by_anchor.values())}))"


def base_places() -> str:
    """SQL array of struct(at, label): all places where a base phrase's words stand."""
    parts = []
    for phrase, label in BASE_PHRASES:
        test = " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
        parts.append(f"transform(filter(transform(words, (w, i) -> case when w = '{phrase.split()[0]}' and {test} then i else -1 end), i -> i >= 0), i -> named_struct('at', cast(i as bigint), 'label', '{label}'))")
    return "concat(" + ", ".join(parts) + ")"


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches``.

    ``matches`` are the detections that stay: word interval, label, priority.  ``score`` is the
    highest priority over 100, or 1 with a base phrase, or 0.  A null or empty text has no words,
    empty labels and null places.  Each row, repeated or with a null id, gives one row.
    """
    rules = rules or build_rules()
    anchors = "(" + ", ".join(f"'{a}'" for a in sorted({r.anchor for r in rules})) + ")"
    body = F.coalesce(F.col(text), F.lit(""))
    lowered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"), F.lower(body).alias("low"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_words"))
    ascii_low = F.translate("body", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    worded = lowered.select("doc_id", "n_words", F.when(gate(F.col("low")), F.array_remove(F.split(ascii_low, SEPARATORS), "")).otherwise(F.expr("cast(array() as array<string>)")).alias("words"))
    placed = worded.select("doc_id", "n_words", F.expr(base_places()).alias("base"), F.expr(f"transform(filter(transform(words, (w, i) -> case when w in {anchors} then i end), i -> i is not null), i -> named_struct('at', i, 'word', words[i], 'window', concat_ws(' ', slice(words, i + 1, {WINDOW}))))").alias("starts"))
    tried = f"""filter(transform(starts, x -> transform(
        filter({rule_table(rules)}[x.word], r -> contains(x.window, r.keyword) and x.window rlike r.pattern),
        r -> named_struct('begin', cast(x.at as bigint), 'stop', x.at + regexp_count(regexp_extract(x.window, r.pattern, 0), ' ') + 1L, 'label', r.label, 'priority', r.priority, 'rank', r.rank))), found -> size(found) > 0)"""
    found = placed.select("doc_id", "n_words", "base", F.expr(f"case when size(starts) > 0 then {tried} else array() end").alias("tried"))
    kept = f"""flatten(transform(tried, (found, i) -> filter(found, x -> not exists(slice(tried, greatest(i - {WINDOW - 2}, 1), least(i + 1, {WINDOW})), near -> exists(near, y ->
        y.begin <= x.begin and y.stop >= x.stop and (y.priority > x.priority or (y.priority = x.priority and
        (y.stop - y.begin > x.stop - x.begin or (y.stop - y.begin = x.stop - x.begin and y.rank < x.rank)))))))))"""
    decided = found.select("doc_id", "n_words", "base", F.expr(kept).alias("matches"))
    base_labels = "array_sort(array_distinct(transform(base, x -> x.label)))"
    return decided.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, x -> x.at))").alias("first_word"),
        F.expr("array_max(transform(base, x -> x.at))").alias("last_word"),
        F.expr(f"array_join({base_labels}, ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_union(transform(base, x -> x.label), transform(matches, x -> x.label))), ',')").alias("labels"),
        F.expr("case when size(base) > 0 then 1D else coalesce(array_max(transform(matches, x -> x.priority)) / 100D, 0D) end").alias("score"),
        "matches",
    )
