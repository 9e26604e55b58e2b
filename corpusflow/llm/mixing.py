"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``BLOCK`` documents. With weight ``w`` its block ``k``
(from 0) is released at slot ``floor(k / w)`` and due at ``ceil((k + 1) / w)``; the slot
goes to the released block that is due first. For weights that sum to 1 this schedule
exists and keeps every source's share of any prefix less than one block from its target.

Weights are exact: targets are ratios of whole numbers (decimals and floats as they are
written), brought to integers ``a`` without a common divisor and of a sum ``Q``. The
schedule repeats after ``Q`` slots, so one period gives the slot of any block by arithmetic. When
a source ends, a phase ends, and the others go on with their own targets' shares. A period longer
than its phase is only made as far as the phase goes. No row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction
from numbers import Rational

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import free_name, saved

BLOCK = 16
#: Default targets: the square roots of the sources' sizes, so that large ones don't drown small ones,
#: as whole parts of the largest, which has this many. They bound the period by this number times that of sources.
DEFAULT_PARTS = 1_000
#: Sources are planned on the driver, by their counts alone; more than this is an error.
MAX_SOURCES = 1_000
#: So many numbers at most make a plan, which is broadcast; targets of a finer ratio than that allows are an error.
MAX_PLAN = 30_000_000
#: Rows of the largest source are ranked in ranges of about this many.
RANGE_ROWS = 128


def period(parts: dict[str, int], left: dict[str, int] | None = None) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period of ``sum(parts)`` slots, earliest deadline first.

    Ties between deadlines go to the earlier release, then to the name. With ``left`` it
    stops at the slot that takes the last of a source's blocks.
    """
    q = sum(parts.values())
    out: dict[str, list[int]] = {s: [] for s in parts}
    waiting = [(0, s) for s in parts]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str]] = []
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            r, s = heapq.heappop(waiting)
            due = -(-(len(out[s]) + 1) * q // parts[s])
            heapq.heappush(ready, (due, r, s))
        due, _, s = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError(f"block of {s} due at {due} only gets slot {slot}")
        out[s].append(slot)
        if left and len(out[s]) == left[s]:
            break
        if len(out[s]) < parts[s]:
            heapq.heappush(waiting, (len(out[s]) * q // parts[s], s))
    return out


def default_targets(sizes: dict[str, int]) -> dict[str, int]:
    """The sources' targets where none are given."""
    top = max(sizes.values(), default=1)
    return {s: max(1, math.floor(DEFAULT_PARTS * math.sqrt(n / top) + 0.5)) for s, n in sizes.items()}


def whole_parts(targets: dict[str, float | str | Rational]) -> dict[str, int]:
    """Positive targets as the smallest integers of exactly the same ratios; a float is the decimal that it prints as."""
    exact = {s: Fraction(w if isinstance(w, Rational) else str(w)) for s, w in targets.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("targets must be positive")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return reduced({s: int(w * scale) for s, w in exact.items()})


def reduced(parts: dict[str, int]) -> dict[str, int]:
    common = math.gcd(*parts.values())
    return {s: a // common for s, a in parts.items()}


def phases(blocks: dict[str, int], parts: dict[str, int], limit: int = MAX_PLAN) -> list[dict]:
    """The phases of a schedule: start slot, period, and for each source its parts, the blocks used before and its slots."""
    left, used, start, out, made = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, [], 0
    while left:
        own = reduced({s: parts[s] for s in left})
        made += min([sum(own.values()), sum(left.values()), *(-(-n * sum(own.values()) // own[s]) for s, n in left.items())])
        if made > limit:
            raise ValueError(f"a plan of more than {limit} numbers; give targets as ratios of smaller whole numbers")
        slots, q = period(own, left), sum(own.values())
        ended = [s for s, n in left.items() if len(slots[s]) == n]
        if ended:
            # the phase ends within its first period: what is made of it is all there is
            end = q = slots[ended[0]][-1] + 1
            own = {s: max(1, len(slots[s])) for s in left}
        else:
            end = min((n - 1) // own[s] * q + slots[s][(n - 1) % own[s]] for s, n in left.items()) + 1
        out.append({"start": start, "q": q, "sources": {s: (own[s], used[s], slots[s]) for s in left}})
        for s in list(left):
            turns, rest = divmod(end, q)
            done = turns * len(slots[s]) + sum(x < rest for x in slots[s])
            used[s] += done
            left[s] -= done
            if not left[s]:
                del left[s]
        start += end
    return out


def mix(docs: DataFrame, weights: dict[str, float | str | Rational] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with ``block_no``, ``slot`` and ``position``: the place of each row in the mixture.

    ``weights`` maps sources to positive targets; without it they are ``default_targets``. A
    source that isn't named has the smallest of the targets. Null sources count as one source of their own.
    Within a source rows stand by a hash of doc_id, then doc_id and text (where there is one), so repeated rows
    and ties have a place each. A block holds ``block`` rows, the last of a source may hold
    fewer; ``position`` leaves their places free and is unique. An empty table gives an
    empty result. Columns of ``docs`` that are called like the new ones are kept with ``_`` after
    their names; texts of any length, and nulls, stay as they are.

    A source is never gathered in one task: its rows are dealt over ranges of the hash, more
    of them the larger the sources are, ranked there, and moved up by the counts of the ranges before.
    """
    spark = docs.sparkSession
    for name in ("block_no", "slot", "position"):
        if free_name(docs, name) != name:
            docs = docs.withColumnRenamed(name, free_name(docs, name + "_"))
    source = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    digest = F.sha2(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    # a row of the caller is one column here, so that no name of it can clash
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source.alias("s"), digest.alias("h"))
    sizes = {r["s"]: r["n"] for r in keyed.groupBy("s").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        targets = default_targets(sizes)
    else:
        given = {s: weights.get(s[1:]) if s[0] == "+" else None for s in sizes}
        least = min((w for w in given.values() if w is not None), key=lambda w: Fraction(w if isinstance(w, Rational) else str(w)), default=1)
        targets = {s: least if w is None else w for s, w in given.items()}
    plan = phases({s: -(-n // block) for s, n in sizes.items()}, whole_parts(targets) if targets else {})
    rows = [(s, p, ph["start"], ph["q"], a, used, slots) for p, ph in enumerate(plan) for s, (a, used, slots) in sorted(ph["sources"].items())]
    table = spark.createDataFrame(rows, "s string, p int, start long, q long, a long, used long, slots array<int>")
    spans = table.selectExpr("s", "start", "q", "a", "used", "slots", "lead(used) over (partition by s order by p) as until")

    bits = max(sizes.values(), default=1) // RANGE_ROWS
    keyed = keyed.withColumn("r", F.shiftright(F.conv(F.substring("h", 1, 15), 16, 10).cast("long"), 60 - bits.bit_length()))
    counts = saved(keyed.groupBy("s", "r").agg(F.count(F.lit(1)).alias("n")), "ranges")
    before = counts.selectExpr("s", "r", "coalesce(sum(n) over (partition by s order by r rows between unbounded preceding and 1 preceding), 0) as before")
    ties = ["h", "row.doc_id", *(["row.text"] if "text" in docs.columns else [])]
    ranked = keyed.withColumn("i", F.expr(f"row_number() over (partition by s, r order by {', '.join(ties)}) - 1"))
    ranked = ranked.join(before, ["s", "r"]).withColumn("i", F.col("i") + F.col("before")).withColumn("block_no", F.floor(F.col("i") / block).cast("long"))
    own, span = ranked.alias("own"), F.broadcast(spans).alias("span")
    on = F.expr("own.s = span.s and own.block_no >= span.used and (span.until is null or own.block_no < span.until)")
    slot = F.expr("start + (block_no - used) div a * q + element_at(slots, cast((block_no - used) % a as int) + 1)")
    placed = own.join(span, on).select("row", "block_no", slot.alias("slot"), "i")
    return placed.select("row.*", "block_no", "slot", (F.col("slot") * block + F.col("i") % block).alias("position"))


def oracle_sql(source: str = "documents", block: int = BLOCK, parts: int = DEFAULT_PARTS) -> str:
    """The mixture with default targets in DuckDB's SQL: the schedule simulated slot by slot, without periods."""
    return f"""
      with recursive n as (select case when source is null then '-' else concat('+', source) end as s, count(*) as n from {source} group by 1),
      a as (select s, n, cast(greatest(1, floor({parts} * sqrt(n / (select max(n) from n)) + 0.5)) as bigint) as a from n),
      init as (select list({{'s': s, 'a': a, 'k': cast(0 as bigint), 'left_': (n + {block - 1}) // {block}}} order by s) as st from a),
      run(slot, start, chosen, st) as (
        select cast(-1 as bigint), cast(0 as bigint), cast('' as varchar), st from init
        union all
        select slot + 1, case when over_ then slot + 2 else start end, pick.s,
          list_filter(list_transform(list_transform(st, lambda x: case when x.s = pick.s then {{'s': x.s, 'a': x.a, 'k': x.k + 1, 'left_': x.left_ - 1}} else x end), lambda x: case when over_ then {{'s': x.s, 'a': x.a, 'k': cast(0 as bigint), 'left_': x.left_}} else x end), lambda x: x.left_ > 0)
        from (select *, pick.left_ = 1 as over_ from (select slot, start, st, list_sort(list_transform(list_filter(list_transform(st, lambda x:
            {{'due': ((x.k + 1) * q + x.a - 1) // x.a, 'free': x.k * q // x.a, 's': x.s, 'left_': x.left_}}), lambda x: x.free <= slot + 1 - start), lambda x: x))[1] as pick
          from (select *, list_sum(list_transform(st, lambda x: x.a)) as q from run) where len(st) > 0))),
      blocks as (select chosen as s, slot, row_number() over (partition by chosen order by slot) - 1 as block_no from run where slot >= 0),
      ranked as (select doc_id, source, case when source is null then '-' else concat('+', source) end as s, row_number() over (partition by source order by sha256(concat('mix:', coalesce(cast(doc_id as varchar), ''))), doc_id) - 1 as i from {source})
      select doc_id, source, i // {block} as block_no, cast(slot as bigint) as slot, cast(slot * {block} + i % {block} as bigint) as position from ranked join blocks on ranked.s = blocks.s and ranked.i // {block} = blocks.block_no"""
