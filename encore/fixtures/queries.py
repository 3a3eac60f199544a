"""Every operator as a query over a directory of fixture tables.

Doubles are rounded to six places and money is DECIMAL(18,2), so that results
can be compared with another engine value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.temporal import ts_literal
from encore.operators import evaluate, features, grain, lifecycle, model, ordering, profile
from encore.operators.features import ModelColumns
from encore.operators.impute import impute_median
from encore.operators.projection import LinearModel, Scaled
from encore.plans import modelling, preparation
from encore.schemas import BASE_TABLE, RAW, with_types
from encore.sources.base_table import load_abt, write_abt
from encore.sources.raw import load_raw, load_table
from encore.sources.staging import new_path, stage
from encore.sources.star import star_raw

COLUMNS = ModelColumns()
LABEL = COLUMNS.label

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles, give every decimal the same type."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DoubleType):
            return F.round(field.name, 6).alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("decimal(18,2)").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema])


# --- sources -----------------------------------------------------------------


def _bigint_keys(schema: T.StructType) -> T.StructType:
    keys = ("order_id", "customer_id", "customer_unique_id", "review_id")
    return with_types(schema, **{k: T.LongType() for k in keys if k in schema.names})


def _raw_through_csv(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    folder = new_path(spark, "raw_csv")
    for name, table in star_raw(spark, sf).items():
        write_abt(table, f"{folder}/{name}.csv", "csv")
    return load_raw(spark, folder, schemas={name: _bigint_keys(schema) for name, schema in RAW.items()})


def raw_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    profiles = [
        profile.schema_profile(table).select(F.lit(name).alias("table_name"), "*")
        for name, table in _raw_through_csv(spark, sf).items()
    ]
    result = profiles[0]
    for other in profiles[1:]:
        result = result.union(other)
    return result


def abt_from_raw_csv(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(preparation.prepare(_raw_through_csv(spark, sf)).base_table)


def abt_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "abt_csv")
    write_abt(_abt(spark, sf), path, "csv")
    return tidy(load_abt(spark, path, "csv", _bigint_keys(BASE_TABLE)))


def csv_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text through a CSV file and back."""
    path = new_path(spark, "texts_csv")
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    write_abt(texts, path, "csv")
    back = load_table(spark, path, texts.schema, multi_line=True)
    return back.select("doc_id", F.char_length("text").alias("n_points"), "text")


def duplicate_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return grain.duplicate_keys(star_raw(spark, sf)["reviews"], ["review_id"])


# --- preparation -------------------------------------------------------------


def _abt(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.prepare(star_raw(spark, sf)).base_table


def _first_purchase(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.first_purchase(preparation.purchase_event(star_raw(spark, sf)))


def review_profile(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(grain.review_profile(star_raw(spark, sf)["reviews"]))


def multi_review_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(grain.review_profile(star_raw(spark, sf)["reviews"]), "multi_review_flag")


def multi_review_share(spark: SparkSession, sf: str) -> DataFrame:
    reviews = grain.review_profile(star_raw(spark, sf)["reviews"])
    return tidy(profile.value_share(reviews, "multi_review_flag"))


def review_order_agg(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(grain.review_order_agg(star_raw(spark, sf)["reviews"]))


def order_items_agg(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(grain.order_items_agg(star_raw(spark, sf)["order_items"]))


def _order_customers(spark: SparkSession, sf: str) -> DataFrame:
    raw = star_raw(spark, sf)
    return grain.join_customers(grain.delivered_orders(raw["orders"]), raw["customers"])


def order_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _order_customers(spark, sf)


def order_base(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(grain.order_base(star_raw(spark, sf)))


def order_event(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(grain.order_event(star_raw(spark, sf)))


def purchase_event(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(preparation.ranked_purchase_event(star_raw(spark, sf)))


def first_purchase_label(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_first_purchase(spark, sf))


def abt(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_abt(spark, sf))


def data_end(spark: SparkSession, sf: str) -> DataFrame:
    raw = star_raw(spark, sf)
    firsts = stage(preparation.first_purchase(preparation.purchase_event(raw)), "first_purchase")
    end = ts_literal(preparation.data_end(raw, firsts))
    return spark.range(1).select(
        end.alias("data_end"), (end - F.make_dt_interval(F.lit(90))).alias("analysis_end")
    )


def review_median(spark: SparkSession, sf: str) -> DataFrame:
    firsts = stage(_first_purchase(spark, sf), "first_purchase")
    median = ordering.exact_quantiles(firsts, [preparation.REVIEW])[preparation.REVIEW]
    counts = firsts.agg(F.count(preparation.REVIEW).alias("known_rows"))
    return tidy(counts.withColumn("median", F.lit(median)))


def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    firsts = stage(_first_purchase(spark, sf), "first_purchase")
    return tidy(impute_median(firsts, preparation.REVIEW).select("customer_unique_id", preparation.REVIEW))


def events_repurchase_label(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    purchases = (
        events.where((F.col("event_type") == "purchase") & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
        .select("user_id", "ts")
        .distinct()
    )
    firsts = lifecycle.first_two_events(purchases, "user_id", "ts", "first_ts", "second_ts", "event_rank")
    labelled = lifecycle.label_within(firsts, "first_ts", "second_ts", 1, "days_to_second", "again_within_1d")
    return labelled.drop("event_rank")


# --- profiles ----------------------------------------------------------------


def null_profile_order_customers(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(_order_customers(spark, sf))


def null_profile_order_base(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(grain.order_base(star_raw(spark, sf)))


def null_profile_order_event(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(grain.order_event(star_raw(spark, sf)))


def null_profile_first_purchase(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(_first_purchase(spark, sf))


def null_profile_imputed(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(preparation.prepare(star_raw(spark, sf)).imputed)


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(_abt(spark, sf))


def schema_profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    return profile.schema_profile(star_raw(spark, sf)["orders"])


def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.schema_profile(tidy(_abt(spark, sf)))


def late_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(grain.order_event(star_raw(spark, sf)), "late_flag")


def has_review_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(grain.order_event(star_raw(spark, sf)), "has_review")


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(_first_purchase(spark, sf), LABEL)


def value_share(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profile.value_share(_abt(spark, sf), LABEL))


# --- modelling ---------------------------------------------------------------


def _split(spark: SparkSession, sf: str) -> ordering.TimeSplit:
    return ordering.time_split(_abt(spark, sf), COLUMNS.ts, COLUMNS.key)


def time_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).rows.select(COLUMNS.key, COLUMNS.ts, "split")


def split_features(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    train, test = (
        features.features_and_target(rows, COLUMNS).withColumn("split", F.lit(name))
        for name, rows in (("train", split.train), ("test", split.test))
    )
    return tidy(train.union(test))


def split_label_rates(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profile.split_label_rates(_split(spark, sf).rows, LABEL))


def one_hot_state(spark: SparkSession, sf: str) -> DataFrame:
    """The one-hot vector of each row as its width and the position of the 1."""
    split = _split(spark, sf)
    fill = F.coalesce("customer_state", F.lit(features.MISSING))
    train, rows = (part.withColumn("customer_state_known", fill) for part in (split.train, split.rows))
    encoder = Pipeline(stages=features.encoder_stages(COLUMNS)).fit(train)
    cells = vector_to_array("customer_state_onehot")
    return (
        encoder.transform(rows)
        .withColumn("_cells", cells)
        .select(
            COLUMNS.key,
            F.size("_cells").alias("width"),
            (F.nullif(F.array_position("_cells", 1.0), F.lit(0)) - 1).cast("int").alias("slot"),
        )
    )


def scaled_numeric(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    scaled = features.cleaner(split.train, COLUMNS).transform(split.rows)
    return tidy(scaled.select(COLUMNS.key, *[f"{c}_scaled" for c in COLUMNS.numeric]))


def scaled_numeric_unimputed(spark: SparkSession, sf: str) -> DataFrame:
    """First purchases split and scaled as they are, so that the imputer meets real nulls."""
    firsts = stage(_first_purchase(spark, sf), "first_purchase")
    split = ordering.time_split(firsts, COLUMNS.ts, COLUMNS.key)
    scaled = features.cleaner(split.train, COLUMNS).transform(split.rows)
    return tidy(scaled.select(COLUMNS.key, *[(F.col(f"{c}_scaled") + 0.0).alias(f"{c}_scaled") for c in COLUMNS.numeric]))


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(features.class_weights(_split(spark, sf).train, LABEL))


def logreg_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """Column sums and the gradient at the fitted model over all training rows."""
    train = _split(spark, sf).train
    weights = features.class_weights(train, LABEL).select(LABEL, "weight")
    fitted = model.fit(train, COLUMNS)
    lines = tidy(model.optimality(fitted, train.join(F.broadcast(weights), LABEL), COLUMNS))
    # no negative zero
    return lines.select("name", (F.col("total") + 0.0).alias("total"), (F.col("gradient") + 0.0).alias("gradient"), "n_wrong")


def logreg_scores(spark: SparkSession, sf: str) -> DataFrame:
    run = modelling.train_and_score(_abt(spark, sf))
    return tidy(run.scored.select(COLUMNS.key, "y_true", "y_prob", "y_pred"))


def logreg_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.classification_metrics(modelling.train_and_score(_abt(spark, sf)).scored))


def logreg_top_decile_lift(spark: SparkSession, sf: str) -> DataFrame:
    run = modelling.train_and_score(_abt(spark, sf))
    return tidy(evaluate.top_fraction_lift(run.scored, COLUMNS.key))


# a model with round numbers, so that another engine can score the same rows
FIXED_MODEL = LinearModel(
    intercept=-0.75,
    numeric={
        "delivery_days_mean": Scaled(median=9.5, mean=12.25, deviation=8.5, coefficient=0.4),
        "first_event_review_score_mean": Scaled(median=4.0, mean=3.75, deviation=1.25, coefficient=-0.6),
    },
    categorical={"customer_state": {"NATION_3": 0.5, "NATION_11": -0.25, "NATION_20": 1.5, features.MISSING: 0.125}},
    binary={"late_flag": 0.875, "has_review": -0.375},
)


def _fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """All first purchases, censored ones and such with unknown numbers too."""
    return FIXED_MODEL.score(_first_purchase(spark, sf), LABEL)


def fixed_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_fixed_scores(spark, sf).select(COLUMNS.key, "y_true", "y_prob", "y_pred"))


def fixed_model_lift(spark: SparkSession, sf: str) -> DataFrame:
    """The lift of the model's best tenth, cut between equal scores by customer."""
    scored = _fixed_scores(spark, sf).select(COLUMNS.key, "y_true", F.round("y_prob", 2).alias("y_prob"))
    return tidy(evaluate.top_fraction_lift(stage(scored, "fixed_scores"), COLUMNS.key))


# --- evaluation of a fixed score -----------------------------------------------


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with a score that is a fixed rule of key and label, not a model."""
    key, label = F.col(COLUMNS.key), F.col(LABEL)
    spread = ((key * 7919) % 101).cast("double") / F.lit(101.0) * F.lit(0.7)
    score = spread + F.lit(0.3) * label.cast("double") * (key % 3).cast("double")
    return _split(spark, sf).test.select(
        COLUMNS.key,
        label.alias("y_true"),
        score.alias("y_prob"),
        (score > 0.5).cast("int").alias("y_pred"),
    )


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_matrix(_scored(spark, sf))


def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.classification_metrics(_scored(spark, sf)))


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.classification_report(_scored(spark, sf)))


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.roc_curve(evaluate.score_curve(_scored(spark, sf))))


def roc_curve_corners(spark: SparkSession, sf: str) -> DataFrame:
    """The points that a drawn line needs."""
    curve = stage(evaluate.score_curve(_scored(spark, sf)), "curve")
    return tidy(evaluate.roc_curve(curve, drop_collinear=True))


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.pr_curve(evaluate.score_curve(_scored(spark, sf))))


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.ranking_metrics(evaluate.score_curve(_scored(spark, sf))).select("roc_auc"))


def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.ranking_metrics(evaluate.score_curve(_scored(spark, sf))).select("pr_auc"))


def top_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(ordering.top_fraction(_scored(spark, sf), "y_prob", COLUMNS.key))


def top_decile_lift(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(evaluate.top_fraction_lift(_scored(spark, sf), COLUMNS.key))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        raw_csv_roundtrip,
        csv_text_roundtrip,
        duplicate_reviews,
        abt_from_raw_csv,
        abt_csv_roundtrip,
        review_profile,
        multi_review_counts,
        multi_review_share,
        review_order_agg,
        order_items_agg,
        order_customers,
        order_base,
        order_event,
        purchase_event,
        first_purchase_label,
        abt,
        data_end,
        review_median,
        median_impute,
        events_repurchase_label,
        null_profile_order_customers,
        null_profile_order_base,
        null_profile_order_event,
        null_profile_first_purchase,
        null_profile_imputed,
        null_profile,
        schema_profile_orders,
        schema_profile,
        late_flag_counts,
        has_review_counts,
        value_counts,
        value_share,
        time_split,
        split_features,
        split_label_rates,
        one_hot_state,
        scaled_numeric,
        scaled_numeric_unimputed,
        class_weights,
        logreg_optimality,
        fixed_model_scores,
        fixed_model_lift,
        logreg_scores,
        logreg_metrics,
        logreg_top_decile_lift,
        confusion_matrix,
        classification_metrics,
        classification_report,
        roc_curve,
        roc_curve_corners,
        pr_curve,
        roc_auc,
        average_precision,
        top_fraction,
        top_decile_lift,
    )
}
