"""Human labels: form records, the newest label of each id, the labelling sample and its agreement with predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.listings import class_label
from tallyspark.sources.stage import staged

SCHEMA = "asin string, class_label string, is_pure_bath_bomb_manual string, n_bomb_balls_manual int, exclude_reason_manual string, notes string, ts double"
SAMPLE_COLUMNS = (
    "asin", "class_label", "count_label", "title", "number_of_items", "size", "is_pure_bath_bomb", "n_bomb_balls", "count_source", "exclude_reason",
    "seller_counts_pack_as_one", "keepa_main_image_url", "keepa_image_count",
)
TRUE, FALSE = ("1", "true", "yes", "y", "1.0"), ("0", "false", "no", "n", "0.0")


def tri_state(value: Column) -> Column:
    """true, false or unsure (as text); null and anything else is unsure."""
    v = F.lower(F.btrim(value.cast("string")))
    return F.when(v.isin(*TRUE), "true").when(v.isin(*FALSE), "false").otherwise("unsure")


def whole(value: Column) -> Column:
    """A number as text, cut to an integer with its sign; null if it is none."""
    text = F.btrim(value.cast("string"))
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,2})?$")
    return F.when(plain, text).try_cast("double").try_cast("int")


def submissions_to_labels(forms: DataFrame) -> DataFrame:
    """Label records of forms (asin, class_label, verdict, n, reason, notes, ts): fields that the verdict rules out are emptied."""
    verdict, n = tri_state(F.col("verdict")), whole(F.col("n"))
    return forms.select(
        "asin", "class_label", F.when(verdict == "unsure", "").otherwise(verdict).alias("is_pure_bath_bomb_manual"),
        F.when((verdict == "true") & (n > 0), n).alias("n_bomb_balls_manual"),
        F.when(verdict == "false", F.coalesce("reason", F.lit(""))).otherwise("").alias("exclude_reason_manual"), "notes", F.col("ts").cast("double").alias("ts"),
        *[c for c in ("seq",) if c in forms.columns],
    )


def accept_predictions(scored: DataFrame, ts: float) -> DataFrame:
    """Predictions taken over as labels."""
    pure = F.coalesce("is_pure_bath_bomb", F.lit(False))
    return scored.select(
        "asin", class_label().alias("class_label"), F.when(pure, "true").otherwise("false").alias("is_pure_bath_bomb_manual"),
        F.when(pure & (F.col("n_bomb_balls") > 0), F.col("n_bomb_balls").cast("int")).alias("n_bomb_balls_manual"),
        F.when(pure, "").otherwise(F.coalesce("exclude_reason", F.lit(""))).alias("exclude_reason_manual"),
        F.lit("accepted rule prediction").alias("notes"), F.lit(ts).cast("double").alias("ts"),
    )


def latest(labels: DataFrame) -> DataFrame:
    """The newest label of each id; seq, where there is one, settles equal times. max_by sums up map-side, so a hot id is one row a task."""
    order = [c for c in ("ts", "seq") if c in labels.columns]
    rest = [c for c in labels.columns if c != "asin"]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return labels.filter(F.col("asin").isNotNull()).groupBy("asin").agg(newest).select("asin", "_r.*")


def upsert(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store with new labels in place of those of the same id; a new label wins over a stored one of equal time."""
    old = store.withColumn("seq", F.lit(-1).cast("bigint"))
    both = old.unionByName(new if "seq" in new.columns else new.withColumn("seq", F.lit(0).cast("bigint")), allowMissingColumns=True)
    return latest(both).select(*store.columns)


def top_of_strata(keys: DataFrame, per: int, order: list[Column], salts: int) -> DataFrame:
    """The first per rows of each class_label of keys (asin, class_label): of each of its salts first, then of what these leave.
    Ids are spread over the salts, so no group holds a class that most rows have."""
    salted = keys.withColumn("_salt", F.pmod(F.xxhash64("asin"), F.lit(salts)))
    for by in (("class_label", "_salt"), ("class_label",)):
        salted = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rank") <= per).drop("_rank")
    return salted.drop("_salt")


def labeling_sample(scored: DataFrame, size: int = 300, seed: int = 42, salt_rows: int = 50_000) -> DataFrame:
    """About size rows, as many of each class as there are, drawn by a hash of seed and id; short strata are topped up.

    Repeated ids count once (the row with the smallest title). A sample larger than size, by many classes, is not cut. Ids and
    classes alone are ranked, in groups of about salt_rows; whole rows are looked up for the ids drawn.
    """
    order = [F.md5(F.concat(F.lit(f"{seed}|"), "asin")), F.col("asin")]
    first_of = F.struct(F.coalesce("title", F.lit("")).alias("title"), "class_label")
    named = scored.filter(F.col("asin").isNotNull())
    keys = staged(named.groupBy("asin").agg(F.min(first_of).alias("_k")).select("asin", F.col("_k.class_label").alias("class_label")), "sampled-from")
    found = keys.groupBy("class_label").agg(F.count("*").alias("n")).agg(F.count("*").alias("classes"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    per = min(size, max(1, size // max(1, found["classes"])))
    drawn = staged(top_of_strata(keys, per, order, max(1, found["n"] // salt_rows)).select("asin"), "sample")
    if need := max(0, size - drawn.count()):
        # Fewer than size ids are broadcast; the rest is a top-k, not a window over a class that may hold most rows.
        rest = keys.select("asin").join(F.broadcast(drawn), "asin", "left_anti")
        drawn = staged(drawn.unionByName(rest.orderBy(*order).limit(need)), "sample")
    # At most size ids, or one for each class.
    rest = [c for c in scored.columns if c not in ("asin", "class_label")]
    rows = named.join(F.broadcast(drawn), "asin").groupBy("asin").agg(F.min_by(F.struct("class_label", *rest), first_of).alias("_r"))
    return rows.select("asin", "_r.*")


def projected(sample: DataFrame) -> DataFrame:
    """The sample's columns in their order, those that are present."""
    return sample.select(*[c for c in SAMPLE_COLUMNS if c in sample.columns])


def agreement(labels: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: labelled, share of equal verdicts, rows with both counts, share of equal counts; shares of nothing are null."""
    both = latest(labels).join(scored.select("asin", "is_pure_bath_bomb", "n_bomb_balls"), "asin")
    manual = tri_state(F.col("is_pure_bath_bomb_manual"))
    same = (manual == "true") == F.coalesce("is_pure_bath_bomb", F.lit(False))
    counted = (manual == "true") & F.col("n_bomb_balls_manual").isNotNull() & F.col("n_bomb_balls").isNotNull()
    known = manual != "unsure"
    return both.agg(
        F.count_if(known).alias("labelled"), F.avg(F.when(known, same.cast("int"))).alias("verdict_share"),
        F.count_if(counted).alias("counted"), F.avg(F.when(counted, (F.col("n_bomb_balls_manual") == F.col("n_bomb_balls")).cast("int"))).alias("count_share"),
    )
