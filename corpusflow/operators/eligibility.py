"""Rights, metadata eligibility, exclusion of evaluation copies, hash-ranked samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.hashing import SEED, is_hex, sha
from corpusflow.session import forget, saved

# Fixed values of the metadata's vocabulary.
LICENSES = tuple(f"https://creativecommons.org/licenses/by/{v}/" for v in ("2.0", "2.5", "3.0", "4.0"))
LICENSE_PREFIX = "https://creativecommons.org/licenses/by/"
ROTATIONS = {f"{d}{tail}": d for d in (0, 90, 180, 270) for tail in ("", ".0")}
MAX_BYTES, MAX_PIXELS, MIN_EDGE = 20 * 1024 * 1024, 40_000_000, 128
FORMATS = ("JPEG", "PNG", "WEBP")


class ManifestError(ValueError):
    """A whole input that can't be used; ``code`` says why."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"{code}: {message}")
        self.code = code


def require_unique(df: DataFrame, key: str, code: str) -> DataFrame:
    """``df``, once no value of ``key`` is repeated; the check counts by partial aggregation."""
    twice = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ManifestError(code, str(twice[0][0]))
    return df


def first_failure(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first failing check (true: it fails), null if none; null tests count as failing."""
    out = None
    for name, fails in checks:
        fails = F.coalesce(fails, F.lit(True))
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return out


def reason_counts(df: DataFrame, reason: str = "reason", passed: str = "eligible") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(reason), F.lit(passed)).alias(reason)).agg(F.count(F.lit(1)).alias("n"))


# -- rights -------------------------------------------------------------------------------


def rights_valid(at: Column, training: bool = False) -> Column:
    """Half-open validity window and permission to process; for training also to train and to share answers."""
    window = (F.col("valid_from") <= at) & (F.col("valid_until").isNull() | (at < F.col("valid_until")))
    allowed = window & F.col("processing_allowed")
    return allowed & F.col("training_allowed") & F.col("qa_redistribution_allowed") if training else allowed


def attach_rights(sources: DataFrame, rights: DataFrame, at: Column, training: Column, strict: bool = True) -> DataFrame:
    """Sources with their rights and a ``reason`` where they may not be used.

    A dangling key aborts all (``strict``), as do repeated ids and empty windows; otherwise
    it is a reason of its own row. The join is left to the optimizer, which broadcasts the
    rights while they are small and shuffles on the key beyond that.
    """
    if strict:
        require_unique(rights, "rights_record_id", "DUPLICATE_RIGHTS_ID")
        if rights.where("valid_until <= valid_from").limit(1).count():
            raise ManifestError("RIGHTS_WINDOW", "valid_until must be later than valid_from")
        lost = sources.join(rights, "rights_record_id", "left_anti").select("rights_record_id").limit(1).collect()
        if lost:
            raise ManifestError("RIGHTS_REFERENCE_MISSING", str(lost[0][0]))
    known = rights.withColumn("__known", F.lit(True))
    joined = sources.join(known, "rights_record_id", "left")
    permitted = F.coalesce(F.when(training, rights_valid(at, True)).otherwise(rights_valid(at)), F.lit(False))
    reason = F.when(F.col("__known").isNull(), "RIGHTS_REFERENCE_MISSING").when(~permitted, "RIGHTS_NOT_PERMITTED")
    return joined.withColumn("reason", reason).drop("__known")


def split_failures(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason, and failed rows with it."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


# -- metadata -----------------------------------------------------------------------------


def rotation_degrees(rotation: Column) -> Column:
    """Degrees of a rotation as written, null if unknown."""
    known = F.create_map(*[F.lit(x) for pair in ROTATIONS.items() for x in pair])
    return F.element_at(known, F.coalesce(rotation, F.lit("?")))


def train_reason(evaluation_id: Column, missing: Column | None = None) -> Column:
    """Why a training metadata row can't be used: the first of seven checks, or null."""
    return first_failure(
        [
            ("invalid_id", ~is_hex(F.col("ImageID"), 16)),
            ("not_train", F.col("Subset") != "train"),
            ("evaluation_id", evaluation_id),
            ("unsupported_license", ~F.col("License").isin(*LICENSES)),
            ("missing_attribution", ~F.coalesce(F.col("Author").rlike(r"(?U)\S"), F.lit(False)) | ~F.col("OriginalLandingURL").startswith("https://")),
            ("unknown_rotation", rotation_degrees(F.col("Rotation")).isNull()),
            *([("missing_or_symlink_when_probed", missing)] if missing is not None else []),
        ]
    )


def validation_eligible() -> Column:
    """Eligibility of a validation metadata row: subset, licence by prefix, at least one URL."""
    url = F.coalesce(F.nullif(F.col("OriginalURL"), F.lit("")), F.nullif(F.col("Thumbnail300KURL"), F.lit("")))
    return F.coalesce((F.col("Subset") == "validation") & F.col("License").startswith(LICENSE_PREFIX) & url.isNotNull(), F.lit(False))


def validation_rotation(rotation: Column) -> Column:
    """Unknown rotations of validation rows count as none."""
    return F.coalesce(rotation_degrees(rotation), F.lit(0))


def attribution(author: Column, landing: Column) -> Column:
    """The author, else the landing page; empty strings count as absent."""
    return F.coalesce(F.nullif(F.trim(author), F.lit("")), landing)


def pinned_failures(pinned: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pinned rows that metadata lacks or contradicts: image_id, reason.

    A pinned row is one row at most, however often metadata repeats its id: it is contradicted
    if no metadata row of its id agrees with it in all three columns. Null ids match each other.
    """
    m = metadata.select(F.col("ImageID").alias("__id"), F.col("License").alias("__l"), attribution(F.col("Author"), F.col("OriginalLandingURL")).alias("__a"), F.col("OriginalLandingURL").alias("__u")).distinct()
    ids = m.select(F.col("__id").alias("__known")).distinct().withColumn("__listed", F.lit(True))
    listed = pinned.join(ids, F.col("image_id").eqNullSafe(F.col("__known")), "left")
    same = F.col("license_uri").eqNullSafe(F.col("__l")) & F.col("attribution").eqNullSafe(F.col("__a")) & F.col("landing_url").eqNullSafe(F.col("__u"))
    joined = listed.join(m.withColumn("__same", F.lit(True)), F.col("image_id").eqNullSafe(F.col("__id")) & same, "left")
    reason = F.when(F.col("__listed").isNull(), "OPEN_IMAGES_PIN_MISSING").when(F.col("__same").isNull(), "OPEN_IMAGES_PIN_PROVENANCE_MISMATCH")
    return joined.select("image_id", reason.alias("reason")).where("reason is not null")


def image_reason() -> Column:
    """Why a decoded image can't be used: bytes, format, frames, pixels, short edge, in this order."""
    return first_failure(
        [
            ("IMAGE_TOO_LARGE", F.col("n_bytes") > MAX_BYTES),
            ("IMAGE_FORMAT_UNSUPPORTED", ~F.col("format").isin(*FORMATS)),
            ("ANIMATED_IMAGE_UNSUPPORTED", F.col("frames") != 1),
            ("IMAGE_PIXEL_LIMIT", F.col("width").cast("long") * F.col("height") > MAX_PIXELS),
            ("IMAGE_EDGE_TOO_SHORT", F.least("width", "height") < MIN_EDGE),
        ]
    )


def safe_path(path: Column) -> Column:
    """Whether a relative path stays under its root."""
    return F.coalesce(~path.rlike(r"(^/)|(^|/)\.\.(/|$)|^\s*$"), F.lit(False))


# -- samples ------------------------------------------------------------------------------


def hash_sample(df: DataFrame, key: str, k: int, seed: int = SEED) -> DataFrame:
    """The ``k`` rows of smallest hash, with ``rank_hash``; the result doesn't depend on the rows' order.

    A bounded heap for each partition and one merge: no full sort, no shuffle of the rest.
    """
    return df.withColumn("rank_hash", sha(seed, F.col(key))).orderBy("rank_hash", key).limit(k)


def probed_sample(df: DataFrame, key: str, k: int, probe: Callable[[DataFrame], DataFrame], seed: int = SEED) -> tuple[DataFrame, int]:
    """The ``k`` rows of smallest hash for which ``probe`` (which adds ``present``) finds something, with ``rank_hash``, and how many were probed.

    Rows are probed in rounds in order of the hash: first those under a cut that is expected to
    hold ``k`` rows, then, while too few are present, as many more as were probed so far. So
    at most about twice the rows needed are probed, each once, and the rows found are those
    that probing all would give. Fewer than ``k`` are returned if there are no more.
    """
    ranked = saved(df.withColumn("rank_hash", sha(seed, F.col(key))), "ranked")
    total, none = ranked.count(), "0" * 64
    parts: list[DataFrame] = []
    low, probed, found = none, 0, 0
    share = min(1.0, k / total) if total else 1.0
    while True:
        # the hash is uniform, so a share of its range holds that share of the rows
        cut = f"{int(share * 2**60):015x}" if share < 1 else "g"
        own = ranked.where((F.col("rank_hash") >= low) & (F.col("rank_hash") < cut))
        parts.append(saved(probe(own), "probed"))
        r = parts[-1].agg(F.count(F.lit(1)).alias("n"), F.count_if("present").alias("found")).first()
        probed, found, low = probed + r["n"], found + r["found"], cut
        if found >= k or share >= 1:
            break
        share = min(1.0, 2 * share)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    forget(ranked)
    return out.where("present").drop("present").orderBy("rank_hash", key).limit(k), probed


def train_sample(metadata: DataFrame, excluded: DataFrame, k: int, seed: int = SEED, probe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``k`` eligible rows by hash; too few, or a sampled id that the whole file repeats, is an error.

    With ``probe``, rows whose file is absent are skipped and the next ranks step in (``probed_sample``).
    """
    marked = metadata.join(excluded.select(F.col("image_id").alias("ImageID")).distinct().withColumn("__x", F.lit(True)), "ImageID", "left")
    eligible = marked.where(train_reason(F.coalesce(F.col("__x"), F.lit(False))).isNull()).drop("__x").dropDuplicates(["ImageID"])
    picked = probed_sample(eligible, "ImageID", k, probe, seed)[0] if probe else hash_sample(eligible, "ImageID", k, seed)
    found = picked.count()
    if found < k:
        raise ManifestError("LOCAL_TRAIN_SHORTFALL", f"asked for {k}, found {found}")
    repeated = metadata.join(picked.select("ImageID"), "ImageID", "left_semi")
    require_unique(repeated, "ImageID", "DUPLICATE_SOURCE_ID")
    return picked


def first_successes(df: DataFrame, key: str, ok: Column, k: int, oversample: int = 20, seed: int = SEED) -> DataFrame:
    """The first ``k`` successes among the ``k * oversample`` rows of smallest hash, with ``ordinal``."""
    top = hash_sample(df, key, k * oversample, seed)
    # at most k * oversample rows are left: a plain limit in order of rank
    return top.where(ok).orderBy("rank_hash", key).limit(k)


def excluded_ids(pinned: DataFrame, *references: DataFrame) -> DataFrame:
    """Ids that training may not use (image_id): those of pinned evaluation rows and of all reference tables of images.

    References have source_id (``prefix:id``) and purpose; one that isn't for evaluation is an error.
    """
    out = pinned.select("image_id")
    for number, images in enumerate(references):
        if images.where(~F.col("purpose").eqNullSafe("evaluation")).limit(1).count():
            raise ManifestError("REFERENCE_NOT_EVALUATION", f"reference {number}")
        out = out.unionByName(images.select(F.element_at(F.split("source_id", ":"), -1).alias("image_id")))
    return out.where("image_id is not null").distinct()


def without_copies(df: DataFrame, reference: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` of which no key pair (own column, reference column) is in the reference: one anti-join for each."""
    for own, other in keys:
        known = reference.select(F.col(other).alias("__k")).where("__k is not null").distinct()
        df = df.join(known, df[own] == known["__k"], "left_anti")
    return df


def repeated_ids(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Chosen ids that the whole table holds more than once, with their count."""
    return df.join(chosen.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n <> 1")


# -- containment of texts -----------------------------------------------------------------

_SPACE = r"[ \t\n\x0B\f\r]+"


#: Texts meet by this many words in a row, or by as many inner ones as the shorter text has.
WINDOW = 4
#: Texts with enough inner words meet by the smallest of this many hashes in a row.
WINNOW = 8
#: Bits of a filter for each hash it knows, and the most bits that one has (8 MB).
FILTER_BITS_EACH, FILTER_BITS_MOST = 16, 1 << 26
#: How a text meets others: 0 without hashes, up to ``WINDOW`` by a run of so many words, this by the smallest hash.
_WINNOWED = WINDOW + 1


def _windows(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(width), F.slice(words, i, width)))


def _smallest(hashes: Column) -> Column:
    """The smallest of each ``WINNOW`` hashes in a row; of all where there are fewer."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - WINNOW + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.array_min(F.slice(hashes, i, WINNOW)))


def hash_filter(keys: DataFrame, count: int) -> Callable[[Column], Column]:
    """A test that every hash of ``keys`` (k) passes and nearly no other one: two bits for each, found by Spark.

    ``count`` sizes it. One of more than ``FILTER_BITS_MOST`` / ``FILTER_BITS_EACH`` hashes lets more others
    pass, which costs time only. It is a scalar subquery, so every task reads the same bounded array.
    """
    bits = 1 << min(FILTER_BITS_MOST.bit_length() - 1, max(12, (FILTER_BITS_EACH * count).bit_length()))
    places = lambda h: [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]
    own = keys.select(F.explode(F.array(*places(F.col("k")))).alias("p"))
    own = own.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bits"))
    # every word is there, so that the array has no gaps
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = own.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    known = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words")).scalar()
    has = lambda p: F.getbit(F.get(known, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
    return lambda h: has(places(h)[0]) & has(places(h)[1])


def short_keys(short: DataFrame) -> DataFrame:
    """short_id, mode and hash ``k`` of each text (id, text): one hash that is among ``long_keys`` of each text that holds it."""
    # no word after these has a say: the rest of a long text stays one piece
    cut = short.select(F.col("id").alias("short_id"), F.split("text", _SPACE, WINDOW + WINNOW + 2).alias("ws"))
    inner = F.greatest(F.size("ws") - 2, F.lit(0))
    mode = F.when(inner >= WINDOW + WINNOW - 1, _WINNOWED).otherwise(F.least(F.lit(WINDOW), inner))
    runs = F.transform(F.sequence(F.lit(2), F.lit(WINNOW + 1)), lambda i: F.xxhash64(F.lit(WINDOW), F.slice("ws", i, WINDOW)))
    k = F.when(mode == _WINNOWED, F.array_min(runs)).when(mode > 0, F.xxhash64(mode, F.slice("ws", F.lit(2), F.greatest(mode, F.lit(1)))))
    return cut.select("short_id", mode.alias("mode"), k.alias("k"))


def long_keys(long: DataFrame, modes: set[int], winnow: bool = True) -> DataFrame:
    """long_id and hash ``k``: the distinct hashes of each text (id, text) by which shorter ones of the given modes meet it.

    Smallest hashes are fewer but dearer to find; ``winnow`` asks for them where all modes allow it.
    """
    cut = long.select(F.col("id").alias("long_id"), F.split("text", _SPACE).alias("ws"))
    if winnow and modes == {_WINNOWED}:
        # a window that both texts have has one smallest hash, so about 2 / (WINNOW + 1) of the hashes are enough
        hashed = cut.select("long_id", _windows(F.col("ws"), WINDOW).alias("h"))
        found = hashed.select("long_id", F.array_distinct(_smallest(F.col("h"))).alias("ks"))
    else:
        widths = sorted({min(m, WINDOW) for m in modes})
        found = cut.select("long_id", F.array_distinct(F.concat(*[_windows(F.col("ws"), w) for w in widths])).alias("ks"))
    # an inner explode would first filter by the array's size, with words split again for each of its elements
    return found.select("long_id", F.explode_outer("ks").alias("k")).where("k is not null")


def containments(long: DataFrame, short: DataFrame, least: int = 1, reference: str = "short") -> DataFrame:
    """Pairs (long_id, short_id) in which ``long.text`` contains ``short.text`` of at least ``least`` characters.

    Both have columns ``id`` and ``text``. A text that holds another one holds all its words
    but the first and last as whole words in a row, so both have the same hashes of runs of ``WINDOW`` of these,
    and of ``WINNOW`` hashes in a row the same smallest one: by its hash a short text meets all texts that
    have it in an equi-join, and only pairs that do fetch their texts and are compared. ``reference`` names the smaller side (``short`` or ``long``):
    hashes of the other one that are not in a filter of its hashes are dropped before they are shuffled. Short
    texts without an inner word, if there are any, are compared one by one, as the only form left. Null texts meet none.
    """
    short = short.where((F.length("text") >= least) & (F.length("text") > 0)).select("id", "text")
    own = long.select(F.col("id").alias("long_id"), F.col("text").alias("__long"))
    other = short.select(F.col("id").alias("short_id"), F.col("text").alias("__short"))
    # one pass over the texts; what follows reads ids and hashes
    keyed = saved(short_keys(short), "keys")
    counts = {r["mode"]: r["n"] for r in keyed.groupBy("mode").agg(F.count(F.lit(1)).alias("n")).collect()}
    modes = set(counts) - {0}
    pairs = own.select("long_id", F.lit(None).cast(short.schema["id"].dataType).alias("short_id")).limit(0)
    if modes:
        # hashes go out without their text; the few candidates fetch it again
        known = sum(counts[m] for m in modes)
        # a filter that isn't full leaves few hashes, so only a full one is helped by winnowing
        dealt = long_keys(long, modes, reference == "long" or known > FILTER_BITS_MOST // FILTER_BITS_EACH)
        keys = keyed.where("k is not null").select("short_id", "k")
        if reference == "short":
            dealt = dealt.where(hash_filter(keys.select("k"), known)(F.col("k")))
        else:
            keys = keys.where(hash_filter(dealt.select("k"), dealt.count())(F.col("k")))
        met = saved(dealt.join(keys, "k").select("long_id", "short_id").distinct(), "candidates")
        found = met.count()
        if found:
            # texts of no candidate stay where they are
            fetch = lambda texts, key: texts.where(hash_filter(met.select(F.xxhash64(key).alias("k")), found)(F.xxhash64(key)))
            near = met.join(fetch(own, "long_id"), "long_id").join(fetch(other, "short_id"), "short_id")
            pairs = pairs.unionByName(near.where(F.col("__long").contains(F.col("__short"))).select("long_id", "short_id"))
    if 0 in counts:
        bare = keyed.where("mode = 0").select("short_id").join(other, "short_id")
        few = own.join(bare, F.col("__long").contains(F.col("__short")))
        pairs = pairs.unionByName(few.select("long_id", "short_id"))
    return pairs.distinct()


def spread_evaluation(df: DataFrame, group: str, is_evaluation: str) -> DataFrame:
    """``df`` with ``purpose``: a whole group is for evaluation once a member is."""
    marks = df.groupBy(group).agg(F.max(F.col(is_evaluation).cast("int")).alias("__m"))
    return df.join(marks, group).withColumn("purpose", F.when(F.col("__m") == 1, "evaluation").otherwise("training")).drop("__m")


METADATA = T.StructType([T.StructField(n, T.StringType()) for n in ("ImageID", "Subset", "License", "Author", "OriginalLandingURL", "Rotation")])
