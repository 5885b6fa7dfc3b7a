"""Operator 3, secret scans: rules as Boolean trigram queries over an inverted index, verified on the whole text."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as kind
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import free_names, put, quoted, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern whose group has at least ``shortest`` characters."""

    name: str
    pattern: str
    group: int = 0
    shortest: int = 1


def either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


#: The first three are the base kinds. hex and access state their least length in the pattern: a maximal run is
#: long enough or it is not, so the matches are those of the shorter pattern that pass.
RULES = (
    Rule("assign", either_case("(?:password|passwd|secret|token|api_?key)") +
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE = ("assign", "access", "hex")

#: Documents whose postings meet in one row.
SHARD_ROWS = 2000
#: Strings that one stretch of a pattern may stand for before it is cut.
MANY = 64

Query = list[list[frozenset[str]]]  # every group must hold; a group holds if all trigrams of one of its sets occur


def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, that every match of the pattern must contain; empty if there are none.

    The pattern is read as stretches of literal strings between gaps of unknown text. Each stretch that is three
    characters long in all its readings gives one group of alternatives.
    """
    groups: Query = []
    run = {""}

    def close() -> None:
        nonlocal run
        if min(map(len, run)) >= 3:
            sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run}
            groups.append(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))
        run = {""}

    def extend(texts: set[str] | None) -> None:
        nonlocal run
        if texts is None:
            close()
        elif len(run) * len(texts) > MANY:
            close()
            run = set(texts) if len(texts) <= MANY else {""}
        else:
            run = {a + b for a in run for b in texts}

    def literal(items) -> set[str] | None:
        """The strings that items stand for, None if too many or unknown."""
        out = {""}
        for op, arg in items:
            if op is kind.LITERAL:
                found = {chr(arg).lower()}
            elif op is kind.IN and all(o in (kind.LITERAL, kind.RANGE) for o, _ in arg):
                found = {chr(c).lower() for o, a in arg for c in ([a] if o is kind.LITERAL else range(a[0], min(a[1], a[0] + MANY) + 1))}
                found = found if len(found) <= 8 else None
            elif op is kind.BRANCH:
                each = [literal(x) for x in arg[1]]
                found = None if any(x is None for x in each) else set().union(*each)
            elif op is kind.SUBPATTERN:
                found = literal(arg[-1])
            elif op in (kind.MAX_REPEAT, kind.MIN_REPEAT) and arg[1] <= 3:
                one = literal(arg[2])
                found = None if one is None else set().union(*(
                    reduce(lambda a, b: {x + y for x in a for y in b}, [one] * n, {""}) for n in range(arg[0], arg[1] + 1)))
            elif op is kind.AT:
                found = {""}
            else:
                found = None
            if found is None or len(out) * len(found) > MANY:
                return None
            out = {a + b for a in out for b in found}
        return out

    def walk(items) -> None:
        for op, arg in items:
            whole = literal([(op, arg)])
            if whole is None and op is kind.SUBPATTERN:
                walk(arg[-1])
            else:
                extend(whole)

    walk(parser.parse(pattern))
    close()
    return groups


def candidates(rows: DataFrame, key: str, text: str, rules: tuple[Rule, ...], shards: int) -> DataFrame:
    """(key, rules): which rules with mandatory trigrams may match, from an inverted index of trigrams.

    Postings are (shard, trigram) -> keys, for the trigrams that some rule asks for. A shard holds about SHARD_ROWS
    documents by their hash, so no trigram, however frequent, has all its postings in one row.
    """
    asked = {r.name: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in asked.values() for group in q for s in group for t in s})
    low = rows.select(key, F.pmod(key, F.lit(shards)).alias("shard"), F.lower(text).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    postings = low.select(key, "shard", F.explode(found).alias("trigram")).groupBy("shard", "trigram").agg(
        F.collect_set(key).alias("keys"))
    index = postings.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("index"))
    none = F.array().cast("array<bigint>")

    def holds(query: Query) -> Column:
        of = lambda t: F.coalesce(F.try_element_at("index", F.lit(t)), none)
        sets = [reduce(F.array_union, [reduce(F.array_intersect, [of(t) for t in sorted(s)]) for s in group]) for group in query]
        return reduce(F.array_intersect, sets)

    named = index.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), holds(q).alias("keys")) for name, q in asked.items()])).alias("hit"))
    return named.select("hit.rule", F.explode("hit.keys").alias(key)).groupBy(key).agg(F.collect_set("rule").alias("rules"))


def ends_of(lengths: Column) -> Column:
    """Running sums of an array, by chunks of 256 so that thousands of matches cost no square of their number."""
    add = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)
    starts = F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 256).cast("int")))
    chunks = F.transform(starts, lambda c: F.slice(lengths, c * 256 + 1, F.lit(256)))
    sums = F.transform(chunks, add)
    return F.flatten(F.transform(chunks, lambda xs, c: F.transform(
        xs, lambda _, i: add(F.slice(sums, F.lit(1), c)) + add(F.slice(xs, F.lit(1), i + 1)))))


def steps_of(match: str, gap: str) -> Column:
    """From the end of one match to the end of the next: the gap before it and its own characters."""
    return F.transform(match, lambda m, j: (F.char_length(m) + F.char_length(F.get(gap, j))).cast("bigint"))


def long_enough(match: str, group: str, stop: str, rank: int, shortest: int) -> Column:
    """The spans of matches whose group has the least length."""
    span = lambda m, j: F.struct(
        (F.get(stop, j) - F.char_length(m)).alias("start"), F.lit(rank).alias("rank"), F.get(stop, j).alias("end"))
    return F.filter(F.transform(match, lambda m, j: F.when(F.char_length(F.get(group, j)) >= shortest, span(m, j))),
                    lambda x: x.isNotNull())


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, output: str = "spans") -> DataFrame:
    """docs with an array of (start, kind, end), code points of the text, in order of start and then of the rules.

    Rules with mandatory trigrams are verified only where the index says they may match; the others scan every text.
    A rule's matches are leftmost and do not overlap; those with too short a group are dropped, and what they covered
    stays used up. Spans of different kinds may overlap.

    The index knows a document by a hash of all its columns: rows that share it are candidates together, and as every
    candidate is verified on its own text, neither repeated rows nor a chance collision change a result. Null and
    empty texts have no spans. An empty table gives no rows. A column with the output's name gives way to it.
    """
    key, body, hit, *arrays = free_names(docs, "key", "body", "hit", *[
        f"{x}{i}" for i in range(len(rules)) for x in ("match", "group", "gap", "size", "stop")])
    rows = docs.select("*", F.xxhash64(*[quoted(c) for c in docs.columns]).alias(key),
                       F.coalesce(F.col(quoted(text)), F.lit("")).alias(body))
    shards = max(1, -(-docs.count() // SHARD_ROWS))
    may = candidates(rows.select(key, body), key, body, rules, shards).select(key, F.col("rules").alias(hit))
    found = rows.join(may, key, "left")
    indexed = {r.name for r in rules if trigram_query(r.pattern)}
    spans = []
    for i, (rule, place) in enumerate(zip(rules, range(0, len(arrays), 5))):
        match, group, gap, size, stop = arrays[place:place + 5]
        look = F.array_contains(hit, rule.name) if rule.name in indexed else F.lit(True)
        pattern = F.lit(rule.pattern)
        found = found.withColumn(match, F.when(look, F.regexp_extract_all(body, pattern, F.lit(0))))
        some = F.size(match) > 0
        found = found.withColumns({
            group: F.when(some, F.regexp_extract_all(body, pattern, F.lit(rule.group)) if rule.group else F.col(match)),
            gap: F.when(some, F.split(body, rule.pattern, -1)),
        })
        found = found.withColumn(size, steps_of(match, gap))
        found = found.withColumn(stop, ends_of(F.col(size)))
        spans.append(F.coalesce(long_enough(match, group, stop, i, rule.shortest), F.expr(
            "cast(array() as array<struct<start:bigint,rank:int,end:bigint>>)")))
    names = F.array(*[F.lit(r.name) for r in rules])
    ordered = F.transform(F.sort_array(F.concat(*spans)), lambda x: F.struct(
        x["start"].alias("start"), F.get(names, x["rank"]).alias("kind"), x["end"].alias("end")))
    return put(found.select(*[quoted(c) for c in docs.columns], ordered.alias(output if output not in docs.columns else key)),
               {output: F.col(output if output not in docs.columns else key)}).drop(*([key] if output in docs.columns else []))


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with a mark in place of every stretch that spans cover; overlapping spans are one stretch."""
    start, end = F.lit(0).cast("bigint"), F.char_length(text).cast("bigint")
    state = F.struct(F.lit("").alias("done"), start.alias("at"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"].cast("int") + 1, F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int"))
        fresh = (x["start"] >= acc["at"]) & ((x["start"] > acc["at"]) | (acc["at"] == 0))
        return F.struct(F.when(fresh, F.concat(acc["done"], gap, F.lit(mark))).otherwise(acc["done"]).alias("done"),
                        F.greatest(acc["at"], x["end"]).alias("at"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, lambda acc: F.concat(
        acc["done"], F.substring(text, acc["at"].cast("int") + 1, (end - acc["at"]).cast("int"))))).otherwise(text)


def digest(scanned: DataFrame) -> DataFrame:
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda name: F.size(F.filter("spans", lambda x: x["kind"] == name)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return scanned.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def _sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""SELECT rid, {i} AS rank, '{r.name}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
            'stop': list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
            'size': length(m[i]), 'own': length(v[i])}})) AS s FROM (
            SELECT rid, regexp_extract_all(body, '{p}') AS m, regexp_extract_all(body, '{p}', {r.group}) AS v,
            string_split_regex(body, '{p}') AS g FROM d WHERE regexp_matches(body, '{p}'))""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents), hits AS (
    {" UNION ALL ".join(parts)}
), spans AS (
    SELECT rid, rank, kind, CAST(s.stop - s.size AS BIGINT) AS a, CAST(s.stop AS BIGINT) AS b FROM hits
    WHERE s.own >= CASE kind {" ".join(f"WHEN '{r.name}' THEN {r.shortest}" for r in RULES)} END
), packed AS (
    SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base
    FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN packed USING (rid)
"""


OP3_SQL = _sql()
