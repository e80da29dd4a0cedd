"""Secret scans with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: what
every match must contain, as ands and ors. The index lists, for blocks of documents,
which of them hold each trigram that some query names; the lists are intersected
and united per block, and only the candidates are searched with the expression. A
rule that has no mandatory trigram is searched in every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from re import _constants as op
from re import _parser as parser

from umbu.llm.tables import if_small, keep, same, table, text_hash
from umbu.llm.words import LOWER, pieces

# Exact strings are followed through an expression up to so many alternatives.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # characters that the match, or the group, must have
    group: int = 0
    any_case: bool = False
    base: bool = True

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


# The base kinds of the contract in its order, then further kinds.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8, group=2, any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]+", 32),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40, base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, base=False),
    Rule("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 27, base=False),
)

Formula = bool | str | tuple  # True (anything), a trigram, ("and" | "or", parts)


def _all(parts) -> Formula:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts) -> Formula:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings) -> Formula:
    """What holds if one of the strings is present."""
    return _any(_all(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _analyse(tree) -> tuple[set[str] | None, Formula]:
    """All strings that a parsed expression can match, if they are few; and its query."""
    exact, queries = {""}, []

    def flush() -> None:
        nonlocal exact
        queries.append(_of_strings(exact))
        exact = {""}

    whole = True
    for code, value in tree:
        query: Formula = True
        if code is op.LITERAL and value < 128:
            found = {chr(value).lower()}
        elif code is op.IN and all(c is op.LITERAL and v < 128 for c, v in value):
            found = {chr(v).lower() for _, v in value}
        elif code is op.SUBPATTERN:
            found, query = _analyse(value[-1])
        elif code is op.BRANCH:
            parts = [_analyse(branch) for branch in value[1]]
            found = set().union(*[p[0] or () for p in parts]) if all(p[0] is not None for p in parts) else None
            query = _any(p[1] if p[0] is None else _of_strings(p[0]) for p in parts)
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            strings, inner_query = _analyse(inner)
            if (low, high) == (0, 1) and strings is not None:
                found = strings | {""}
            else:
                found, query = None, inner_query if low else True
                if low and strings is not None:
                    query = _of_strings(strings)
        elif code is op.AT:
            found = {""}
        else:
            found = None
        if found is not None and len(exact) * len(found) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in found}
            continue
        whole = False
        flush()
        if found is not None and len(found) <= MOST_STRINGS:
            exact = found
        else:
            queries.append(query)
    if whole:
        return exact, True
    flush()
    return None, _all(queries)


def trigram_query(pattern: str) -> Formula:
    """What the lower-cased text of every match must contain; True if nothing is sure."""
    exact, query = _analyse(parser.parse(pattern, re.ASCII))
    return query if exact is None else _of_strings(exact)


def trigrams_of(formula: Formula) -> set[str]:
    if isinstance(formula, tuple):
        return set().union(*[trigrams_of(p) for p in formula[1:]])
    return {formula} if isinstance(formula, str) else set()


def _code(trigram: str) -> int:
    a, b, c = trigram.encode()
    return a << 16 | b << 8 | c


def _indexer(codes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = np.zeros(1 << 24, dtype=bool)
        named[codes] = True
        for batch in batches:
            for piece in pieces(batch.column(2)):
                low = LOWER[piece.data].astype(np.uint32)
                triple = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
                at = np.flatnonzero(named[triple])
                doc = np.searchsorted(piece.bounds, at, side="right") - 1
                inside = at + 3 <= piece.bounds[np.minimum(doc + 1, len(piece.bounds) - 1)]
                n = piece.last - piece.first
                posting = np.unique(triple[at[inside]].astype(np.int64) * n + doc[inside])
                terms, firsts = np.unique(posting // n, return_index=True)
                lists = np.split((posting % n).astype(np.int32), firsts[1:])
                ids = [batch.column(i).slice(piece.first, n).to_pylist() for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[0]], pa.list_(pa.int64())), pa.array([ids[1]], pa.list_(pa.int64())),
                        pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([[x.tolist() for x in lists[: len(terms)]]], pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["doc_id", "text_hash", "trigrams", "postings"],
                )

    return run


def trigram_index(docs: DataFrame, trigrams: set[str]) -> DataFrame:
    """For blocks of documents: which of them hold which of the trigrams."""
    rows = docs.select(F.col("doc_id").cast("bigint"), text_hash(), "text")
    schema = "doc_id array<bigint>, text_hash array<bigint>, trigrams array<int>, postings array<array<int>>"
    return rows.mapInArrow(_indexer(sorted(map(_code, trigrams))), schema)


def _matcher(formulas: list[Formula]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_id"])
                lists = dict(zip(row["trigrams"], row["postings"]))

                def holds(formula: Formula) -> np.ndarray:
                    if isinstance(formula, str):
                        out = np.zeros(n, dtype=bool)
                        out[lists.get(_code(formula), [])] = True
                        return out
                    parts = [holds(p) for p in formula[1:]]
                    return np.logical_and.reduce(parts) if formula[0] == "and" else np.logical_or.reduce(parts)

                rules = sum(holds(f).astype(np.int64) << i for i, f in enumerate(formulas) if f is not True)
                at = np.flatnonzero(rules)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([row["doc_id"][i] for i in at], pa.int64()),
                        "text_hash": pa.array([row["text_hash"][i] for i in at], pa.int64()),
                        "rules": pa.array(rules[at], pa.int64()),
                    }
                )

    return run


def find_spans(text: str, rules: Sequence[Rule], chosen: int) -> list[tuple[int, int, int]]:
    """(start, end, rule number) of all matches of the chosen rules, in order."""
    out = []
    for number, rule in enumerate(rules):
        if chosen >> number & 1:
            for m in re.finditer(rule.pattern, text, rule.flags):
                if len(m[rule.group]) >= rule.least:
                    out.append((m.start(), m.end(), number))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _finder(rules: Sequence[Rule], always: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = []
            for text, chosen in zip(batch.column(1), batch.column(2)):
                found = find_spans(text.as_py() or "", rules, (chosen.as_py() or 0) | always)
                spans.append([{"kind": rules[k].kind, "start": a, "end": b} for a, b, k in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return run


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end in code points) of every row.

    Spans go by start, then by the order of the rules; those of one rule do not
    overlap. A null text is empty and has none. Null ids and repeated rows are kept;
    an empty table gives no rows.
    """
    formulas = [trigram_query(rule.pattern) for rule in rules]
    always = sum(1 << i for i, f in enumerate(formulas) if f is True)
    index = keep(trigram_index(docs, set().union(*map(trigrams_of, formulas))), "trigrams")
    found = index.mapInArrow(_matcher(formulas), "doc_id bigint, text_hash bigint, rules bigint")
    found = if_small(keep(found.distinct(), "candidates"))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", text_hash())
    rows = rows.join(found, same(rows, found, ["doc_id", "text_hash"]), "left").select(
        rows["doc_id"], "text", "rules"
    )
    schema = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(_finder(rules, always), schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, a row each; see ``scan_secrets`` for all cases."""
    base = [rule.kind for rule in RULES if rule.base]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", *[s[n].cast("string") for n in ("kind", "start", "end")])))
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    """Places of matches from the texts between them."""
    parts = []
    for number, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        if rule.any_case:
            head, tail = pattern.split(")", 1)
            pattern = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", head) + ")" + tail
        parts.append(f"""
  SELECT r, '{rule.kind}' AS kind, {number} AS number, unnest(generate_series(1, len(m))) AS i, m, gap,
    regexp_extract_all(t, '{pattern}', {rule.group}) AS g
  FROM (SELECT r, t, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS gap FROM doc)""")
    least = " ".join(f"WHEN '{rule.kind}' THEN {rule.least}" for rule in RULES)
    base = ", ".join(f"'{rule.kind}'" for rule in RULES if rule.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    named = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
span AS (
  SELECT r, kind, number, start, start + length(m[i]) AS stop FROM (
    SELECT *, list_sum(list_transform(gap[1:i], lambda x: length(x)))::BIGINT
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start FROM found)
  WHERE length(g[i]) >= CASE kind {least} END),
named AS (
  SELECT r, {counts},
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) FILTER (kind IN ({base})) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans
  FROM span GROUP BY r)
SELECT doc_id, {named}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN named USING (r)
"""


SQL = _sql()
