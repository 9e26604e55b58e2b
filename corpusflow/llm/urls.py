"""URL filters: allow and block rules, then gradient-boosted trees on lexical features.

Trees are grown on the driver from a bounded table of labelled URLs; what runs over the
pages is one SQL expression: features, rules and trees written out as ``CASE``. The query's
oracle reaches the same by another way: characters counted as rows, and leaves as boxes in a table.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The query's rules: verdict, then host and path prefix in one.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
TREES, DEPTH, RATE, LEAST = 24, 3, 0.3, 3
#: Labelled URLs beyond this many, by rank of a hash, aren't fitted on.
TRAIN_ROWS = 20_000
FEATURES = ("length", "depth", "digit_ratio", "entropy", "params", "hyphens", "longest_label", "labels", "suffix_rate")

#: What labelled URLs are made of, by class (1: to block): words of hosts and paths, suffixes with weights, shapes of hosts and of what follows.
#: Both classes share shapes, in other proportions, so that no single one decides.
LABELLED_ROWS = 600
WORDS = {
    0: "garden library museum physics harbour recipes weather school poems maps forum choir history orchard clinic theatre railway island botany letters town observatory farm songs".split(),
    1: "win bonus pills casino cheap bets loan track ads spin replica diet crypto deals free jackpot meds followers poker payday offers slots clicks farm".split(),
}
SUFFIXES = {0: {"com": 34, "org": 20, "net": 12, "edu": 8, "gov": 5, "de": 6, "fr": 5, "es": 5, "info": 3, "io": 2}, 1: {"com": 34, "net": 14, "org": 12, "xyz": 10, "top": 9, "info": 7, "click": 7, "biz": 5, "de": 1, "fr": 1}}
PREFIXES = {0: {"": 40, "www.": 30, "blog.": 18, "m.": 8, "docs.": 4}, 1: {"": 52, "www.": 26, "m.": 14, "go.": 8}}
HOSTS = {0: {"{a}": 46, "{a}{b}": 40, "{a}-{b}": 5, "{b}.{a}": 9}, 1: {"{a}-{b}": 66, "{a}{b}": 12, "{a}{n}": 7, "{a}-{b}{d}": 8, "{a}-{b}-{c}": 7}}
PATHS = {
    0: {"/": 10, "/{l}/{m}": 26, "/{l}/{m}/": 8, "/{l}/{m}.html": 8, "/{l}/{m}?page=2": 5, "/{l}/{m}?utm_source=feed": 5, "/{l}/{m}#top": 5, "/{a}/{b}": 12, "/{a}/2024/05/{b}": 8, "/{a}/{b}-{c}": 7, "/{a}/{b}/{c}.html": 6},
    1: {"/": 6, "/{l}/{m}": 26, "/{l}/{m}/": 7, "/{l}/{m}?page=2&ref=x": 7, "/{l}/{m}.html": 6, "/r?id={n}&src=mail&u={n}": 13, "/{a}?bonus={m}&ref=aff{d}&cb={n}": 12, "/item-{n}-{d}.html": 9, "/{a}/{b}/{c}/{n}/{d}": 8, "/{a}/{n}": 6},
}


def labelled_urls(rows: int = LABELLED_ROWS, salt: str = "train", words: dict[int, list[str]] | None = None) -> tuple[list[str], list[int]]:
    """A table of labelled URLs made by rule: each choice is a hash of the row's number, so that the table is always the same."""
    words, urls, blocked = words or WORDS, [], []

    def pick(options: dict[str, int] | list[str], *name: object) -> str:
        options = options if isinstance(options, dict) else dict.fromkeys(options, 1)
        at = crc32(":".join(map(str, (salt, *name))).encode()) * 2654435761 % (1 << 32) % sum(options.values())
        for option, weight in options.items():
            at -= weight
            if at < 0:
                return option
        raise AssertionError

    for row in range(rows):
        y = row % 2
        number = lambda size, k: str(crc32(f"{salt}:{row}:{size}:{k}".encode()) % 10**size)  # noqa: B023, E731
        fill = lambda form, part: form.format(a=pick(words[y], row, part, "a"), b=pick(words[y], row, part, "b"), c=pick(words[y], row, part, "c"), l=pick(["en", "en", "de", "fr", "es"], row, part), m=number(3, part), n=number(6, part), d=number(1, part))  # noqa: B023, E731
        host = pick(PREFIXES[y], row, "prefix") + fill(pick(HOSTS[y], row, "host"), "h") + "." + pick(SUFFIXES[y], row, "suffix")
        urls.append(pick(["http", "https"], row, "scheme") + "://" + host + fill(pick(PATHS[y], row, "path"), "p"))
        blocked.append(y)
    return urls, blocked


def parts_of(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min((k for k in (rest.find(c) for c in "/?#") if k >= 0), default=len(rest))
    path = rest[cut:]
    end = min((k for k in (path.find(c) for c in "?#") if k >= 0), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def features_of(url: str | None, rates: dict[str, float], prior: float) -> list[float]:
    """The features in Python, for fitting and for tests; ``feature_sql`` is the same."""
    text = url or ""
    host, path = parts_of(url)
    n = len(text)
    entropy = sum(-c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0
    query = text.partition("?")[2].partition("#")[0]
    params = query.count("&") + 1 if query else 0
    labels = host.split(".")
    digits = sum("0" <= c <= "9" for c in text)
    return [n, path.count("/"), digits / n if n else 0.0, entropy, params, host.count("-"), max(map(len, labels)), len(labels), rates.get(labels[-1], prior)]


def feature_sql(rates: dict[str, float], prior: float, dialect: str) -> dict[str, str]:
    """SQL of each feature over the columns ``url`` (null: empty), ``host`` and ``path``."""
    count = lambda x, c: f"(length({x}) - length(replace({x}, '{c}', '')))"
    if dialect == "spark":
        chars, labels, last = "array_distinct(split(url, ''))", "split(host, '[.]')", "element_at(split(host, '[.]'), -1)"
        entropy = f"aggregate(filter({chars}, c -> c <> ''), cast(0 as double), (s, c) -> s - ent(c))"
        longest = f"array_max(transform({labels}, x -> length(x)))"
        size, query = f"size({labels})", "split_part(substring(url, instr(url, '?') + 1), '#', 1)"
        digits = "(length(url) - length(translate(url, '0123456789', '')))"
    else:
        labels, last = "string_split(host, '.')", "string_split(host, '.')[-1]"
        entropy = "coalesce(list_sum(list_transform(filter(list_distinct(string_split(url, '')), lambda c: c <> ''), lambda c: -ent(c))), 0)"
        longest = f"list_max(list_transform({labels}, lambda x: length(x)))"
        size, query = f"len({labels})", "split_part(substr(url, strpos(url, '?') + 1), '#', 1)"
        digits = "(length(url) - length(regexp_replace(url, '[0-9]', '', 'g')))"
    share = "(cast(length(url) - length(replace(url, c, '')) as double) / length(url))"
    log2 = "ln({}) / ln(cast(2 as double))".format(share)
    entropy = entropy.replace("ent(c)", f"{share} * ({log2})")
    at = "instr(url, '?')" if dialect == "spark" else "strpos(url, '?')"
    rate = " ".join(f"when {_text(k)} then {_real(v)}" for k, v in sorted(rates.items()))
    return {
        "length": "cast(length(url) as double)",
        "depth": f"cast({count('path', '/')} as double)",
        "digit_ratio": f"case when url = '' then cast(0 as double) else cast({digits} as double) / length(url) end",
        "entropy": f"case when url = '' then cast(0 as double) else cast({entropy} as double) end",
        "params": f"cast(case when {at} = 0 or {query} = '' then 0 else {count(query, '&')} + 1 end as double)",
        "hyphens": f"cast({count('host', '-')} as double)",
        "longest_label": f"cast({longest} as double)",
        "labels": f"cast({size} as double)",
        "suffix_rate": f"case {last} {rate} else {_real(prior)} end" if rates else _real(prior),
    }


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "''") + "'"


def _real(x: float) -> str:
    return f"cast('{x!r}' as double)"


class Model:
    """Suffix statistics and boosted trees: ``margin`` in Python, ``sql`` for both dialects."""

    def __init__(self, urls: list[str], blocked: list[int]) -> None:
        n, own = Counter(), Counter()
        for u, y in zip(urls, blocked, strict=True):
            suffix = parts_of(u)[0].split(".")[-1]
            n[suffix] += 1
            own[suffix] += y
        self.prior = (sum(blocked) + 1) / (len(blocked) + 2)
        # shrunk towards the overall rate by ten rows, so that a rare suffix says little
        self.rates = {s: (own[s] + 10 * self.prior) / (n[s] + 10) for s in n}
        x = [features_of(u, self.rates, self.prior) for u in urls]
        self.start = math.log(self.prior / (1 - self.prior))
        margin, self.trees = [self.start] * len(urls), []
        if not urls or len(set(blocked)) < 2:
            return
        for _ in range(TREES):
            p = [1 / (1 + math.exp(-m)) for m in margin]
            g, h = [y - q for y, q in zip(blocked, p, strict=True)], [q * (1 - q) for q in p]
            tree = self._grow(x, g, h, list(range(len(urls))), DEPTH)
            self.trees.append(tree)
            margin = [m + self._leaf(tree, row) for m, row in zip(margin, x, strict=True)]

    def _grow(self, x: list, g: list, h: list, rows: list[int], depth: int) -> tuple:
        total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
        leaf = ("leaf", RATE * total_g / (total_h + 1.0))
        if depth == 0 or len(rows) < 2 * LEAST:
            return leaf
        best, gain = None, 1e-9
        for f in range(len(FEATURES)):
            order = sorted(rows, key=lambda i: x[i][f])  # noqa: B023
            low_g = low_h = 0.0
            for k, i in enumerate(order[:-1]):
                low_g, low_h = low_g + g[i], low_h + h[i]
                a, b = x[i][f], x[order[k + 1]][f]
                if a == b or k + 1 < LEAST or len(order) - k - 1 < LEAST:
                    continue
                new = low_g**2 / (low_h + 1) + (total_g - low_g) ** 2 / (total_h - low_h + 1) - total_g**2 / (total_h + 1)
                if new > gain + 1e-12:
                    best, gain = (f, (a + b) / 2), new
        if best is None:
            return leaf
        f, cut = best
        return ("split", f, cut, self._grow(x, g, h, [i for i in rows if x[i][f] <= cut], depth - 1), self._grow(x, g, h, [i for i in rows if x[i][f] > cut], depth - 1))

    def _leaf(self, tree: tuple, row: list) -> float:
        while tree[0] == "split":
            tree = tree[3] if row[tree[1]] <= tree[2] else tree[4]
        return tree[1]

    def margin(self, url: str | None) -> float:
        row = features_of(url, self.rates, self.prior)
        return self.start + sum(self._leaf(t, row) for t in self.trees)

    def _case(self, tree: tuple) -> str:
        if tree[0] == "leaf":
            return _real(tree[1])
        return f"case when f_{FEATURES[tree[1]]} <= {_real(tree[2])} then {self._case(tree[3])} else {self._case(tree[4])} end"

    def sql(self) -> str:
        """The margin over columns ``f_<feature>``."""
        return " + ".join([_real(self.start), *(f"({self._case(t)})" for t in self.trees)])


@cache
def default_model() -> Model:
    return Model(*labelled_urls())


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a table of ``url`` and ``blocked`` (0 or 1), on at most ``rows`` rows by rank of a hash."""
    got = labelled.select("url", F.col("blocked").cast("int").alias("blocked")).where("url is not null and blocked in (0, 1)").orderBy(F.xxhash64("url"), "url", "blocked").limit(rows).collect()
    return Model([r["url"] for r in got], [r["blocked"] for r in got])


def _rule_cases(rules: tuple, what: int) -> str:
    cases = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        path = "/" + path
        # the host itself, or a subdomain of it
        cases.append(f"when (host = {_text(host)} or right(host, {len(host) + 1}) = {_text('.' + host)}) and left(path, {len(path)}) = {_text(path)} then {_text((verdict, rule)[what])}")
    return f"case {' '.join(cases)} end" if cases else "cast(null as string)"


def query_sql(source: str, model: Model | None = None, rules: tuple = RULES, dialect: str = "spark", key: str = "page_id") -> str:
    """The whole filter as SQL over a table or view with ``url`` and a key."""
    model = model or default_model()
    at = "instr" if dialect == "spark" else "strpos"
    cut, upper, lower = "substr", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    exact = feature_sql(model.rates, model.prior, dialect)
    kind = "string" if dialect == "spark" else "varchar"
    return f"""
      with whole as (select {key}, coalesce(url, '') as url from {source}),
      rest as (select *, case when {at}(url, '://') > 0 then {cut}(url, {at}(url, '://') + 3) else '' end as rest from whole),
      hosts as (select *, regexp_extract(rest, '^[^/?#]*', 0) as host0 from rest),
      parted as (select {key}, url, translate(host0, '{upper}', '{lower}') as host, regexp_extract({cut}(rest, length(host0) + 1), '^[^?#]*', 0) as path from hosts),
      featured as (select *, {", ".join(f"{v} as f_{k}" for k, v in exact.items())} from parted),
      judged as (select {key}, host, path, cast({_rule_cases(rules, 1)} as {kind}) as rule, cast({_rule_cases(rules, 0)} as {kind}) as said, {model.sql()} as margin from featured)
      select {key}, host, path, rule, coalesce(said, case when margin > 0 then 'block' else 'allow' end) as verdict,
        case when margin > 0 then 'block' else 'allow' end as method_verdict, round(1 / (1 + exp(-margin)), 6) as score
      from judged"""


def judge(pages: DataFrame, model: Model | None = None, rules: tuple = RULES, key: str = "page_id") -> DataFrame:
    """One row per page: the key, host, path, rule, verdict, method_verdict, score.

    The rule of longest host and path that fits decides, else the trees do (``block`` above
    one half). Null URLs and ones without ``://`` have an empty host and path, fit no rule
    and go by the trees. Repeated rows give repeated rows, an empty table an empty result;
    other columns are ignored.
    """
    return pages.sparkSession.sql(query_sql("{pages}", model, rules, "spark", key), pages=pages.select(key, "url"))


def _boxes(tree: tuple, low: tuple, high: tuple) -> list[tuple]:
    """The leaves of a tree as boxes: value, then the bounds of each feature (above low, up to high)."""
    if tree[0] == "leaf":
        return [(tree[1], low, high)]
    _, f, cut, less, more = tree
    put = lambda bounds, x: (*bounds[:f], x, *bounds[f + 1 :])
    return _boxes(less, low, put(high, min(high[f], cut))) + _boxes(more, put(low, max(low[f], cut)), high)


def oracle_sql(source: str = "pages") -> str:
    """The default query in DuckDB's SQL, by another way: characters as rows, leaves as boxes, rules as a table."""
    model, n = default_model(), len(FEATURES)
    wide = lambda x: f"'{x!r}'::double" if math.isfinite(x) else f"'{'-' if x < 0 else ''}infinity'::double"
    boxes = [(t, value, *low, *high) for t, tree in enumerate(model.trees) for value, low, high in _boxes(tree, (-math.inf,) * n, (math.inf,) * n)]
    leaves = ", ".join("(" + ", ".join(map(wide, b)) + ")" for b in boxes)
    names = ", ".join(["tree", "value", *(f"low_{f}" for f in FEATURES), *(f"high_{f}" for f in FEATURES)])
    within = " and ".join(f"f.{f} > b.low_{f} and f.{f} <= b.high_{f}" for f in FEATURES)
    rates = ", ".join(f"('{k}', {wide(v)})" for k, v in sorted(model.rates.items()))
    rules = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in RULES)
    return f"""
      with p as (select row_number() over () as k, page_id, coalesce(url, '') as url from {source}),
      cut as (select *, regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's') as host0, regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's') as path from p),
      h as (select *, list_aggregate(list_transform(string_split(host0, ''), lambda c: case when c between 'A' and 'Z' then chr(ascii(c) + 32) else c end), 'string_agg', '') as host1 from cut),
      u as (select k, page_id, url, coalesce(host1, '') as host, path from h),
      chars as (select k, c, count(*) as n from (select k, unnest(string_split(url, '')) as c from u where url <> '') group by k, c),
      ent as (select chars.k, sum(-(n / length(url)) * log2(n / length(url))) as e, sum(n) filter (c between '0' and '9') as digits from chars join u using (k) where c <> '' group by chars.k),
      rates(suffix, rate) as (values {rates}),
      f as (select u.k, page_id, host, path, cast(length(url) as double) as length, cast(len(string_split(path, '/')) - 1 as double) as depth,
          coalesce(digits / length(url), 0) as digit_ratio, coalesce(e, 0) as entropy,
          cast(case when query = '' then 0 else len(string_split(query, '&')) end as double) as params, cast(len(string_split(host, '-')) - 1 as double) as hyphens,
          cast((select max(length(x)) from (select unnest(string_split(host, '.')) as x)) as double) as longest_label, cast(len(string_split(host, '.')) as double) as labels,
          coalesce(rate, {wide(model.prior)}) as suffix_rate
        from (select *, case when strpos(url, '?') = 0 then '' else regexp_extract(url, '[?]([^#]*)', 1, 's') end as query from u) u left join ent on ent.k = u.k left join rates on suffix = list_extract(string_split(host, '.'), -1)),
      leaves({names}) as (values {leaves}),
      votes as (select f.k, list(b.value order by b.tree) as votes from f join leaves b on {within} group by f.k),
      margins as (select k, list_reduce(list_prepend({wide(model.start)}, votes), lambda a, b: a + b) as margin from votes),
      rules(verdict, rule_host, rule_path, rule) as (values {rules}),
      fits as (select f.k, arg_max(r.rule, length(r.rule)) as rule, arg_max(r.verdict, length(r.rule)) as verdict from f join rules r on (f.host = r.rule_host or ends_with(f.host, '.' || r.rule_host)) and starts_with(f.path, r.rule_path) group by f.k)
      select f.page_id, f.host, f.path, fits.rule, coalesce(fits.verdict, case when margin > 0 then 'block' else 'allow' end) as verdict,
        case when margin > 0 then 'block' else 'allow' end as method_verdict, round(1 / (1 + exp(-margin)), 6) as score
      from f join margins using (k) left join fits using (k)"""
