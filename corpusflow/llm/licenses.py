"""License scans in DataFrame expressions: gated signature rules, priority and containment.

Only texts with one of the rules' keywords as a word go beyond counting words, and of the
rules only those whose keyword a text holds are tried on it. All places of all rules
become intervals of words. An interval that lies inside another one of at least its priority
(for equal intervals: or of an earlier rule) is suppressed; one sweep in order of starts finds these.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.license_rules import rules

#: Base phrases and their labels; a base label always stays.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Places that are summed up one by one.
BLOCK = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What isn't part of a word, once A-Z are lower-cased (here: before, so A-Z are part of words).
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spaces(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


def _gate(keywords: list[str]) -> str:
    """A text without capitals of these words; one pass over the text decides."""
    return f" (?:{'|'.join(sorted(map(re.escape, keywords), key=lambda k: (-len(k), k)))})(?= )"


def _apart(pattern: str) -> str:
    """A rule's pattern for words two spaces apart: every space twice, but for those in a class of characters."""
    inner = pattern.removesuffix("(?= )")[1:]
    return f" {re.sub(r'\[[^]]*\]| [?]| ', lambda m: {' ?': '(?:  )?', ' ': '  '}.get(m[0], m[0]), inner)} "


def oracle_sql(source: str = "documents") -> str:
    """The scan in DuckDB's SQL, by another way: rules joined to texts by keyword, pairs of intervals compared.

    Words stand two spaces apart there, so that each has its own borders and no lookahead is needed.
    """
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({n}, {p}, {quote(label)}, {quote(k)}, {quote(_apart(x))})" for n, p, label, k, x in rules())
    base = ", ".join(f"({quote(p)}, {quote(label)}, {len(p.split())})" for p, label in BASE)
    words = "(length({0}) - length(replace({0}, ' ', ''))) // 2"
    sums = lambda m: f"list_sum(list_transform(g[1:k], lambda x: {words.format('x')})) + coalesce(list_sum(list_transform(m[1:{m}], lambda x: {words.format('x')})), 0)"
    return f"""
      with r(rule, priority, label, keyword, pattern) as (values {rows}),
      w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as words from {source}),
      d as (select *, concat(' ', array_to_string(words, '  '), ' ') as body from w),
      p as (select doc_id, b.label, unnest(list_filter(range(1, len(words) - b.k + 2), lambda i: array_to_string(words[i:i + b.k - 1], ' ') = b.phrase)) - 1 as place from d, (values {base}) b(phrase, label, k)),
      f as (select doc_id, rule, priority, label, string_split_regex(body, pattern) as g, regexp_extract_all(body, pattern) as m from d join r on list_contains(words, keyword)),
      h as (select doc_id, rule, priority, label, g, m, unnest(range(1, len(m) + 1)) as k from f),
      i as (select doc_id, rule, priority, label, {sums("k - 1")} as a, {sums("k")} as z from h),
      kept as (select * from i h where not exists (select 1 from i o where o.doc_id = h.doc_id and o.a <= h.a and o.z >= h.z and o.priority >= h.priority
        and (o.a <> h.a or o.z <> h.z or o.priority > h.priority or o.rule < h.rule))),
      bl as (select doc_id, count(*) as n, min(place) as first_word, max(place) as last_word, list_sort(list_distinct(list(label))) as labels from p group by 1),
      kl as (select doc_id, count(*) as n, list(label) as labels from kept group by 1)
      select d.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(bl.n, 0) as bigint) as n_base, cast(bl.first_word as bigint) as first_word, cast(bl.last_word as bigint) as last_word,
        array_to_string(coalesce(bl.labels, []), ',') as base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(bl.labels, []), coalesce(kl.labels, [])))), ',') as labels,
        1 - pow(0.5, coalesce(kl.n, 0) + len(coalesce(bl.labels, []))) as score
      from d left join bl on d.doc_id = bl.doc_id left join kl on d.doc_id = kl.doc_id"""


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``detections`` has the intervals that stay: first word, end, priority, rule, label.
    ``score`` is ``1 - 2 ** -k`` for ``k`` intervals that stay and base labels. Null and
    empty texts have no words, no labels and score 0; repeated rows give repeated rows, an
    empty table an empty result; other columns are ignored. No row leaves its partition.
    Texts of any length are scanned whole, and the work follows their length and the number
    of places of all rules in them.
    """
    table = rules()
    keywords = sorted({r[3] for r in table} | {p.split()[-1] for p, _ in BASE})
    flat = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _BETWEEN, " "))
    own = docs.select(F.col(doc_id).alias("doc_id"), flat.alias("flat"))
    own = own.withColumn("n_words", F.expr(f"case when flat = '' then 0L else cast({_spaces('flat')} + 1 as bigint) end"))
    gate = F.concat(F.lit(" "), F.col("flat"), F.lit(" "))
    own = own.withColumn("words", F.when(gate.rlike("(?i)" + _gate(keywords)), F.translate(gate, _UPPER, _LOWER))).drop("flat")
    own = own.withColumn("found", F.expr(f"array_distinct(transform(regexp_extract_all(words, {_sql(_gate(keywords))}, 0), x -> trim(x)))"))

    parts = own
    for k, (phrase, _) in enumerate(BASE):
        parts = parts.withColumn(f"base{k}", F.expr(f"split(words, {_sql(f' (?={phrase} )')}, -1)"))
    n_of = [f"coalesce(size(base{k}) - 1, 0)" for k in range(len(BASE))]
    has = [f"(base{k} is not null and size(base{k}) > 1)" for k in range(len(BASE))]
    first = ", ".join(f"case when {h} then {_spaces(f'base{k}[0]')} end" for k, h in enumerate(has))
    last = ", ".join(f"case when {h} then n_words - {_spaces(f'element_at(base{k}, -1)')} end" for k, h in enumerate(has))
    labels = ", ".join(f"case when {h} then '{BASE[k][1]}' end" for k, h in enumerate(has))
    parts = parts.select(
        "doc_id",
        "n_words",
        "words",
        "found",
        F.expr(f"cast({' + '.join(n_of)} as bigint)").alias("n_base"),
        F.expr(f"cast(least({first}) as bigint)").alias("first_word"),
        F.expr(f"cast(greatest({last}) as bigint)").alias("last_word"),
        F.expr(f"array_sort(filter(array({labels}), x -> x is not null))").alias("base"),
    )
    literal = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(k).alias("keyword"), F.lit(x).alias("pattern")) for n, p, label, k, x in table])
    kept = _kept(_intervals(parts, literal), max(r[1] for r in table))
    return kept.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("kept", lambda x: x["label"])))), ",").alias("labels"),
        (1 - F.pow(F.lit(0.5), F.size("kept") + F.size("base"))).alias("score"),
        F.col("kept").alias("detections"),
    )


def _let(name: str, values: dict[str, str], then: str) -> str:
    """SQL of ``then``, in which the fields of ``name`` are values that are evaluated once."""
    return f"transform(array(struct({', '.join(f'{v} as {k}' for k, v in values.items())})), {name} -> {then})[0]"


def _blocks(items: str) -> str:
    """SQL of an array cut into blocks of ``BLOCK`` items."""
    return f"transform(sequence(0, (size({items}) - 1) div {BLOCK}), b -> slice({items}, b * {BLOCK} + 1, {BLOCK}))"


def _intervals(parts: DataFrame, literal: Column) -> DataFrame:
    """All places of the rules whose keyword a text holds, as intervals of words in order of start, longest first.

    A place starts at the sum of all words before it. Sums run inside of blocks of a fixed size
    and over the blocks' totals, so the work follows the number of places.
    """
    tried = F.when(F.size("found") > 0, F.filter(literal, lambda r: F.array_contains(F.col("found"), r["keyword"])))
    total = "aggregate({}, 0, (s, y) -> s + y)"
    before = f"aggregate(q.blocks, struct(0 as at, cast(array() as array<int>) as out), (acc, x) -> struct(acc.at + {total.format('x')} as at, array_append(acc.out, acc.at) as out), acc -> acc.out)"
    sums = f"flatten(transform(t.blocks, (x, b) -> transform(x, (y, i) -> t.before[b] + {total.format('slice(x, 1, i)')})))"
    place = "struct(s.sums[k] + s.gaps[k] as first, -(s.sums[k] + s.gaps[k] + x) as last, -r.priority as rank, r.rule as rule, r.priority as priority, r.label as label)"
    hits = _let("s", {"sums": sums, "gaps": "t.gaps", "got": "t.got"}, f"transform(s.got, (x, k) -> {place})")
    hits = _let("t", {"blocks": "q.blocks", "before": before, "gaps": "q.gaps", "got": "q.got"}, hits)
    hits = _let("q", {"blocks": _blocks("p.steps"), "gaps": "p.gaps", "got": "p.got"}, hits)
    hits = _let("p", {"steps": "zip_with(slice(o.gaps, 1, size(o.got)), o.got, (a, z) -> a + z)", "gaps": "o.gaps", "got": "o.got"}, hits)
    hits = _let("o", {"gaps": f"transform(split(words, r.pattern, -1), x -> {_spaces('x')})", "got": f"transform(regexp_extract_all(words, r.pattern, 0), x -> {_spaces('x')})"}, hits)
    return parts.withColumn("tried", tried).withColumn("hits", F.expr(f"array_sort(coalesce(flatten(transform(tried, r -> {hits})), array()))")).drop("tried", "words", "found")


def _kept(hits: DataFrame, levels: int) -> DataFrame:
    """The intervals that no earlier one of their priority or more reaches beyond.

    ``ends[p]`` is the farthest end so far of priority over ``p``: of the blocks before, and of the
    intervals before in the same block.
    """
    farthest = "aggregate({}, -1, (e, y) -> if(y.priority >= {}, greatest(e, -y.last), e))"
    ends = f"transform(sequence(1, {levels}), p -> {farthest.format('x', 'p')})"
    before = f"aggregate(q.blocks, struct(array_repeat(-1, {levels}) as ends, cast(array() as array<array<int>>) as out), (acc, x) -> struct(zip_with(acc.ends, {ends}, (a, z) -> greatest(a, z)) as ends, array_append(acc.out, acc.ends) as out), acc -> acc.out)"
    stays = f"t.before[b][h.priority - 1] < -h.last and {farthest.format('slice(x, 1, i)', 'h.priority')} < -h.last"
    kept = _let("t", {"blocks": "q.blocks", "before": before}, f"flatten(transform(t.blocks, (x, b) -> filter(x, (h, i) -> {stays})))")
    kept = _let("q", {"blocks": _blocks("hits")}, kept)
    shown = "transform(kept, h -> struct(h.first as first, -h.last as end, h.priority as priority, h.rule as rule, h.label as label))"
    return hits.withColumn("kept", F.expr(kept)).withColumn("kept", F.expr(shown)).drop("hits")
