"""The review queue: filters, search, facets, evidence and form defaults over scored listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.rules import CLASS_LABELS
from tallyspark.operators import labels as lab
from tallyspark.operators.listings import class_label, count_label

ROW = "_row"  # the place of a listing in its file

# Evidence fields in their order.
EVIDENCE = (
    ("title", "cand_title", "cand_title_pattern"), ("size", "cand_size", "cand_size_pattern"), ("bullets", "cand_bullets", "cand_bullets_pattern"),
    ("description", "cand_description", "cand_description_pattern"), ("number_of_items", "cand_number_of_items", None),
    ("keepa_number_of_items", "cand_keepa_number_of_items", None), ("keepa_package_qty", "cand_keepa_package_qty", None),
    ("unit_num", "cand_unit_num", None), ("label_unit_num", "cand_label_unit_num", None),
)
CATALOG_FIELDS = (
    "brand", "manufacturer", "price", "per_unit_price_text", "unit_text", "number_of_items", "size", "item_weight", "product_dimensions", "variation_quantity",
    "badge_label", "image_num", "keepa_number_of_items", "keepa_package_quantity", "keepa_item_weight_g", "keepa_image_count", "keepa_variation_count",
)
MAX_DESCRIPTION = 4000
COUNT_LABELS = ("multi_pack", "single", "pack_as_one", "extreme_count", "count_unable", "n/a")


def with_labels(queue: DataFrame) -> DataFrame:
    """class_label and count_label, added where the queue has a verdict but no class yet."""
    if "class_label" in queue.columns or "is_pure_bath_bomb" not in queue.columns:
        return queue
    return queue.withColumns({"class_label": class_label(), "count_label": count_label()})


def recombine(parsed: DataFrame | None, results: DataFrame | None) -> DataFrame:
    """Parsed rows with their results; either may be absent. Columns that both have come from parsed. Where both have row
    numbers, rows join by these alone, so equal ids stay apart; tables in buckets of them join without a shuffle."""
    if parsed is None or results is None:
        return results if parsed is None else parsed
    return enrich(parsed, results, ROW if ROW in parsed.columns and ROW in results.columns else "asin")


def enrich(queue: DataFrame, full: DataFrame, key: str = "asin") -> DataFrame:
    """The queue with the columns of full that it lacks."""
    missing = [c for c in full.columns if c not in queue.columns]
    return queue.join(full.select(key, *missing), key, "left") if missing else queue


def pick(
    queue: DataFrame, *, needs_review: bool = False, conflict: bool = False, classes: tuple[str, ...] = (), counts: tuple[str, ...] = (),
    confidences: tuple[str, ...] = (), search: str = "",
) -> DataFrame:
    """The queue under filters; an empty choice filters nothing, a null flag is false, search is a regular expression in id or title."""
    flags = [c for c, on in (("needs_review", needs_review), ("count_conflict", conflict)) if on]
    for c in flags:
        queue = queue.filter(F.coalesce(c, F.lit(False)))
    for c, chosen in (("class_label", classes), ("count_label", counts), ("count_confidence", confidences)):
        if chosen:
            queue = queue.filter(F.col(c).isin(*chosen))
    if word := search.strip().lower():
        queue = queue.filter(F.lower("asin").rlike(word) | F.coalesce(F.lower("title").rlike(word), F.lit(False)))
    return queue


def unlabelled(queue: DataFrame, labels: DataFrame) -> DataFrame:
    return queue.join(labels.select("asin").distinct(), "asin", "left_anti")


def facets(queue: DataFrame) -> DataFrame:
    """(facet, value, n, place) of classes, count labels and confidences, and of the two flags; one scan, summed map-side.

    place is the value's place among the labels, from 1; values of one facet are shown by place, then by name.
    """
    value = lambda facet, v: F.struct(F.lit(facet).alias("facet"), v.alias("value"))
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "true")
    every = F.array(
        value("class_label", F.col("class_label")), value("count_label", F.col("count_label")), value("count_confidence", F.col("count_confidence")),
        value("needs_review", flag("needs_review")), value("count_conflict", flag("count_conflict")),
    )
    listed = lambda names: F.array_position(F.array(*[F.lit(x) for x in names]), F.col("value")).cast("int")
    place = F.when(F.col("facet") == "class_label", listed(CLASS_LABELS)).when(F.col("facet") == "count_label", listed(COUNT_LABELS)).otherwise(0)
    return queue.select(F.explode(every).alias("f")).select("f.*").filter("value IS NOT NULL").groupBy("facet", "value").agg(F.count("*").alias("n")).withColumn("place", place)


def evidence(scored: DataFrame) -> DataFrame:
    """(asin, field, count, pattern): the candidates of each row in long form."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(n).cast("int").alias("count"), (F.coalesce(p, F.lit("")) if p else F.lit("")).alias("pattern")) for f, n, p in EVIDENCE])
    return scored.select("asin", F.explode(F.filter(rows, lambda r: r["count"].isNotNull())).alias("e")).select("asin", "e.*")


def catalog_evidence(listings: DataFrame) -> DataFrame:
    """The catalogue fields that are present, as a JSON object without nulls."""
    have = [c for c in CATALOG_FIELDS if c in listings.columns]
    return listings.select("asin", F.to_json(F.struct(*have)).alias("fields"))


def text_evidence(listings: DataFrame) -> DataFrame:
    """bullets as an array and the description's start; the catalogue's where the listing has none."""
    items = F.split(F.coalesce("feature", "keepa_features", F.lit("")), r" \| ")
    return listings.select(
        "asin", F.filter(F.transform(items, lambda x: F.btrim(x)), lambda x: x != "").alias("bullets"),
        F.substring(F.coalesce("product_description", "keepa_description"), 1, MAX_DESCRIPTION).alias("description"),
    )


def title_highlight() -> Column:
    """The title with ** around the first stand-alone occurrence of its candidate count."""
    n = F.col("cand_title").cast("string")
    found = F.regexp_replace("title", F.concat(F.lit(r"(?s)^(.*?)(?<!\d)("), n, F.lit(r")(?!\d)")), F.lit("$1**$2**"))
    return F.when(n.isNotNull(), found).otherwise(F.col("title"))


def prefill(queue: DataFrame, labels: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """Form defaults: the saved label as a whole if there is one, else the prediction."""
    saved = lab.latest(labels).select(
        "asin", F.lit(True).alias("_saved"), lab.tri_state(F.col("is_pure_bath_bomb_manual")).alias("_pure"), F.col("n_bomb_balls_manual").alias("_n"),
        F.col("exclude_reason_manual").alias("_reason"), F.col("notes").alias("_notes"),
    )
    j = queue.select("asin", "is_pure_bath_bomb", "n_bomb_balls", "exclude_reason").join(saved, "asin", "left")
    already = F.coalesce("_saved", F.lit(False))
    reason = F.when(already, F.col("_reason")).otherwise(F.col("exclude_reason"))
    return j.select(
        "asin", F.when(already, F.col("_pure")).otherwise(lab.tri_state(F.col("is_pure_bath_bomb"))).alias("verdict"),
        F.when(already, F.col("_n")).otherwise(F.col("n_bomb_balls").cast("int")).alias("n"), F.when(reason.isin(*vocabulary), reason).otherwise("").alias("reason"),
        F.when(already, F.coalesce("_notes", F.lit(""))).otherwise("").alias("notes"), already.alias("already"),
    )


def progress(queue: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: labelled ids, ids in the queue, those without a label."""
    ids = queue.select("asin").filter("asin IS NOT NULL").distinct().withColumn("_q", F.lit(1))
    done = labels.select("asin").filter("asin IS NOT NULL").distinct().withColumn("_d", F.lit(1))
    j = ids.join(done, "asin", "full")
    return j.agg(F.count("_d").alias("labelled"), F.count("_q").alias("queued"), F.count_if(F.col("_q").isNotNull() & F.col("_d").isNull()).alias("unlabelled"))
