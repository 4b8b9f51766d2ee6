"""Record-table operators on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.scalars import (
    censored,
    feature_name,
    outcome,
    parse_date,
    survival_days,
    years,
)
from cohortline.operators import assemble, cleaning, cohort, prep
from cohortline.plans import jobs
from cohortline.plans.durable import new_path
from cohortline.sources import catalogue, quoted, registry, tables

OFFSET_DAYS = 30
PRIORITY_CODES = {
    "1-URGENT": "1",
    "2-HIGH": "2",
    "3-MEDIUM": "4",
    "4-NOT SPECIFIED": None,
}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = _table(spark, sf, "customer"), _table(spark, sf, "nation")
    dirty = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("PatientID"),
        F.col("c_name").alias(" C.Name (choice=A)"),
        F.col("c_acctbal").alias("%Acct, Balance-Now "),
        F.col("n_name").alias("Nation.Name"),
    )
    return cleaning.clean_names(dirty, {"patientid": "patient_id", "absent": "ignored"})


def na_tokens(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    dirty = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", "N/A")
        .when(F.col("event_type") == "view", " null ")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(F.col("event_type") == "click", float("nan")).otherwise(F.col("value")).alias("value"),
    )
    return cleaning.null_tokens(dirty)


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("user_id").alias("Subject ID"),
        F.col("event_type").alias("Modality"),
        F.col("props").alias("File Location"),
    )
    split = F.lit("2024-01-03").cast("timestamp_ntz")
    return catalogue.tagged_union(
        {
            "dataset1": events.filter(F.col("ts") < split),
            "dataset2": events.filter(F.col("ts") >= split),
        }
    )


def metadata_tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return _catalogue(spark, sf).select(
        "event_id", F.col("Dataset").alias("dataset"), F.col("Modality").alias("modality")
    )


def series_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _catalogue(spark, sf)
    first = catalogue.first_series(rows, ["event_id"], base="base")
    subjects = rows.filter(F.col("Modality") == "error").select("Subject ID").distinct()
    wanted = catalogue.series_of(subjects, first.filter(F.col("Modality").isin("click", "view")))
    return wanted.select(
        F.col("Subject ID").alias("subject"), F.col("Modality").alias("modality"), "path"
    )


def eligible_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.eligible_subjects(
        _table(spark, sf, "orders"), "o_custkey", "o_orderstatus", wanted="F", single="P"
    )


def chunk_assign(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.assign_chunks(_table(spark, sf, "orders"), "o_custkey", "o_orderkey")


def _recoded(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("stage"),
        F.col("o_orderstatus").alias("event"),
    )
    stage = cleaning.recode(orders, PRIORITY_CODES, ["stage"])
    return cleaning.recode(stage, {"F": "1", "O": "0"}, ["event"])


def value_recode(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.to_numbers(_recoded(spark, sf), {"stage": "int", "event": "int"})


def recode_leftovers(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders")
    priority = cleaning.recode_leftovers(orders, PRIORITY_CODES, ["o_orderpriority"])
    status = cleaning.recode_leftovers(orders, {"F": "1", "O": "0"}, ["o_orderstatus"])
    return priority.unionByName(status)


def sentinel_fill_then_null(spark: SparkSession, sf: str) -> DataFrame:
    coded = cleaning.to_numbers(_recoded(spark, sf), {"stage": "int"}).select("o_orderkey", "stage")
    return cleaning.value_to_null(cleaning.fill_sentinel(coded, ["stage"]), "stage", 4)


def lower_strings(spark: SparkSession, sf: str) -> DataFrame:
    part = _table(spark, sf, "part").select(
        F.concat(F.lit("ID "), F.col("p_partkey").cast("string")).alias("part_id"),
        "p_name", "p_brand", "p_type", "p_size",
    )
    return cleaning.spaces_to_underscores(cleaning.lower_strings(part, ["part_id"]), "p_name")


def conditional_default(spark: SparkSession, sf: str) -> DataFrame:
    customer = _table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return cleaning.default_where(
        customer, "c_acctbal", F.col("c_mktsegment") == "MACHINERY", 0.0
    )


def or_flag(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("first"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("second"),
    )
    marked = lines.replace({"A": "wildtype", "O": "wildtype"}, subset=["first", "second"])
    return cleaning.flag_either(marked, "flag", "first", "second").select(
        "l_orderkey", "l_linenumber", "flag"
    )


def _followed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as records: last ship date against order date, both as text."""
    orders, lines = _table(spark, sf, "orders"), _table(spark, sf, "lineitem")
    last = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.date_format(F.max("l_shipdate"), "M/d/yyyy").alias("last_seen")
    )
    return orders.join(last, "o_orderkey", "left").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_totalprice",
        "last_seen",
        # One text format of two, and one that fits neither.
        F.when(F.col("o_orderpriority") == "5-LOW", "not a date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("first_seen"),
        F.when(F.col("o_orderstatus") == "F", 1)
        .when(F.col("o_orderstatus") == "O", 0)
        .alias("event"),
        F.when(F.col("o_totalprice") > 250000, F.floor(F.col("o_totalprice") / 300).cast("double"))
        .alias("recorded"),
    )


def _days() -> Column:
    return survival_days(
        parse_date("last_seen"), parse_date("first_seen"), F.lit(OFFSET_DAYS), F.col("recorded")
    )


def survival(spark: SparkSession, sf: str) -> DataFrame:
    rows = _followed(spark, sf).withColumn("days", _days())
    return rows.select("o_orderkey", "days", F.round(years(F.col("days")), 6).alias("years"))


def censor_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _followed(spark, sf).withColumn("years", years(_days()))
    return rows.filter(~censored(F.col("years"), F.col("event"))).select("o_orderkey", "event")


def outcome_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = _followed(spark, sf).withColumn("years", years(_days()))
    return rows.select("o_orderkey", outcome(F.col("years"), F.col("event")).alias("death_2years"))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.label_outcome(_followed(spark, sf), _days(), F.col("event"))


def cohort_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf)
    even = cleaning.drop_columns(
        rows.filter("o_custkey % 2 = 0"), ["last_seen", "first_seen", "event", "recorded"]
    )
    odd = rows.filter("o_custkey % 2 = 1").withColumn("extra", F.lit("x"))
    return cohort.union_common(even, odd)


def label_join_drop(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = _table(spark, sf, "labels").withColumn(
        "quality", F.when(F.col("toxic") == 0, F.col("quality"))
    )
    return assemble.join_label(documents, labels, "doc_id", "quality")


def full_left_join(spark: SparkSession, sf: str) -> DataFrame:
    labels = _table(spark, sf, "labels").withColumnRenamed("quality", "death_2years")
    vectors = _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.aggregate(
            "embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double")
        ).alias("total"),
        F.lit(0).alias("death_2years"),
    )
    joined = assemble.join_features(labels, vectors, "doc_id")
    return joined.withColumn("total", F.round("total", 6))


def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    labels = _table(spark, sf, "labels")
    documents = _table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    joined = assemble.join_label(documents, labels, "doc_id", "quality")
    return assemble.summarise_all(
        {
            "followed_orders": _labelled(spark, sf).select(
                "o_orderkey", "o_orderpriority", "o_totalprice",
                F.col("death_2years").alias("label"),
            ),
            "labels": labels.withColumnRenamed("quality", "label"),
            "labelled_documents": joined.withColumnRenamed("quality", "label"),
        },
        "label",
    )


def study_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The five datasets of a study, written, opened by name and summarised."""
    root = new_path(spark, "study")
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"),
        F.col("c_acctbal").alias("age"),
        F.col("c_mktsegment").alias("histology"),
        F.when(F.col("c_nationkey") % 5 != 0, (F.col("c_nationkey") % 4 == 0).cast("int")).alias("death_2years"),
        F.col("c_custkey").alias("key"),
    )
    first = customers.filter("key % 2 = 0").drop("key")
    second = customers.filter("key % 2 = 1").drop("key")
    images = customers.filter("key % 3 = 0").select(
        "patient_id", (F.col("age") * 2).alias("volume"), F.lit(1).alias("death_2years")
    )
    tables.write_table(first, f"{root}/clinical1")
    tables.write_table(second, f"{root}/clinical2")
    tables.write_table(cohort.union_common(first, second), f"{root}/clinical_joined")
    tables.write_table(images, f"{root}/image_features")
    return jobs.datasets_report(registry.study_datasets(spark, root))


def first_file(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the first shipped part of each order, as frames of a series' first file."""
    lines = _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("series_id"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("file_name"),
        F.col("l_linenumber").alias("frame"),
    )
    return catalogue.first_file(lines)


def display_names(spark: SparkSession, sf: str) -> DataFrame:
    """Feature names as shown in a report, from the distinct brands of the parts."""
    part = _table(spark, sf, "part").select("p_brand", "p_type").distinct()
    qualified = F.concat_ws("__", F.lower("p_brand"), F.replace(F.col("p_type"), F.lit(" "), F.lit("_")))
    return part.select("p_brand", "p_type", feature_name(qualified).alias("feature"))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as many delimited files and read back as one table."""
    orders = _table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )
    path = new_path(spark, "csv")
    tables.write_csv(orders.repartition(4, "o_orderkey"), path)
    strict = tables.read_csv(spark, path, orders.schema)
    loose = tables.infer_types(tables.read_csv(spark, path), ["o_orderkey"])
    return strict.join(
        loose.select(
            F.col("o_orderkey").cast("long").alias("o_orderkey"),
            F.col("o_totalprice").alias("inferred_price"),
        ),
        "o_orderkey",
    )


def raw_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through a raw file: dotted headers, quotes and line breaks, then clean names and types."""
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Patient.ID"),
        F.col("c_acctbal").alias("Age.at.Histology (choice=x)"),
        F.concat(F.col("c_name"), F.lit(' said "yes",\n then left')).alias("Note"),
        F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey")).alias("Weight.%"),
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_mktsegment")).otherwise("N/A").alias("Market.Segment"),
    )
    path = new_path(spark, "csv")
    tables.write_csv(customers, path)
    clean = tables.infer_types(cleaning.clean_names(tables.read_csv(spark, path)))
    roles = prep.column_roles(clean, ["patient_id", "note"])
    kinds = F.array_join(F.array(*[F.lit(c) for c in sorted(roles["numeric"])]), ", ")
    return clean.withColumn("numeric_columns", kinds)


def quoted_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents through delimited files whose cells hold quotes and line breaks."""
    path = new_path(spark, "csv")
    tables.write_csv(_table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    read = quoted.read_quoted(spark, path)
    return read.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.length("text").cast("long").alias("n"), F.md5(F.col("text").cast("binary")).alias("digest"),
    )


QUERIES = {
    "clean_names": clean_names,
    "na_tokens": na_tokens,
    "metadata_tagged_union": metadata_tagged_union,
    "series_lookup": series_lookup,
    "eligible_cohort": eligible_cohort,
    "chunk_assign": chunk_assign,
    "value_recode": value_recode,
    "recode_leftovers": recode_leftovers,
    "sentinel_fill_then_null": sentinel_fill_then_null,
    "lower_strings": lower_strings,
    "conditional_default": conditional_default,
    "or_flag": or_flag,
    "survival_days": survival,
    "censor_filter": censor_filter,
    "outcome_label": outcome_label,
    "cohort_union": cohort_union,
    "label_join_drop": label_join_drop,
    "full_left_join": full_left_join,
    "dataset_summary": dataset_summary,
    "display_names": display_names,
    "csv_roundtrip": csv_roundtrip,
    "raw_csv": raw_csv,
    "quoted_csv": quoted_csv,
    "study_registry": study_registry,
    "first_file": first_file,
}

_CATALOGUE = """
cat AS (
    SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-03' THEN 'dataset1' ELSE 'dataset2' END AS dataset
    FROM events)
"""
_RECODED = """
coded AS (
    SELECT o_orderkey,
        CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4 END AS stage,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS event
    FROM orders)
"""
_FOLLOWED = f"""
last AS (SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS seen FROM lineitem GROUP BY ALL),
base AS (
    SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS event,
        coalesce(
            CASE WHEN o_orderpriority <> '5-LOW'
                THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(seen AS DATE)) - {OFFSET_DAYS} AS DOUBLE) END,
            CASE WHEN o_totalprice > 250000 THEN CAST(floor(o_totalprice / 300) AS DOUBLE) END) AS days
    FROM orders LEFT JOIN last USING (o_orderkey)),
followed AS (SELECT *, days / 365.25 AS years FROM base),
labelled AS (
    SELECT *, CASE WHEN years < 2 AND event = 1 THEN 1 ELSE 0 END AS death_2years
    FROM followed WHERE NOT coalesce(years < 2 AND event = 0, FALSE))
"""


def _summary(name: str, features: int, rows: str) -> str:
    return f"""
        SELECT '{name}' AS dataset, count(label) AS observations, {features} AS n_features,
            CAST(round_even(100 * avg(label), 1) AS VARCHAR) || '%' AS percent_positive
        FROM ({rows})"""


ORACLES = {
    "clean_names": """
        SELECT c_custkey AS patient_id, c_name AS c_name_a, c_acctbal AS acct_balancenow, n_name AS nation_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "na_tokens": """
        SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS event_type,
            CASE WHEN event_type <> 'click' THEN value END AS value
        FROM events""",
    "metadata_tagged_union": f"""WITH {_CATALOGUE}
        SELECT event_id, dataset, event_type AS modality FROM cat""",
    "series_lookup": f"""WITH {_CATALOGUE}
        SELECT user_id AS subject, event_type AS modality,
            'base/' || arg_min(dataset, event_id) || '/' || arg_min(props, event_id) AS path
        FROM cat WHERE event_type IN ('click', 'view')
            AND user_id IN (SELECT user_id FROM cat WHERE event_type = 'error')
        GROUP BY user_id, event_type""",
    "eligible_cohort": """
        SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (
            SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey HAVING count(*) = 1)""",
    "chunk_assign": """
        WITH k AS (SELECT o_custkey, min(o_orderkey) AS f FROM orders GROUP BY ALL),
        p AS (SELECT o_custkey, row_number() OVER (ORDER BY f, o_custkey) - 1 AS position FROM k)
        SELECT o_custkey, position,
            CAST(position // ((SELECT count(*) FROM k) // 12 + 1) + 1 AS INTEGER) AS chunk FROM p""",
    "value_recode": f"WITH {_RECODED} SELECT o_orderkey, stage, event FROM coded",
    "recode_leftovers": """
        SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS n FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') GROUP BY ALL
        UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders
        WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY ALL""",
    "sentinel_fill_then_null": f"""WITH {_RECODED}
        SELECT o_orderkey, nullif(coalesce(stage, -1), 4) AS stage FROM coded""",
    "lower_strings": """
        SELECT 'ID ' || p_partkey AS part_id, replace(lower(p_name), ' ', '_') AS p_name,
            lower(p_brand) AS p_brand, lower(p_type) AS p_type, p_size FROM part""",
    "conditional_default": """
        SELECT c_custkey, c_mktsegment,
            CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer""",
    "or_flag": """
        SELECT l_orderkey, l_linenumber,
            CASE WHEN l_returnflag = 'A' OR l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS flag FROM lineitem""",
    "survival_days": f"""WITH {_FOLLOWED}
        SELECT o_orderkey, days, round(years, 6) AS years FROM followed""",
    "censor_filter": f"""WITH {_FOLLOWED}
        SELECT o_orderkey, event FROM followed WHERE (years < 2 AND event = 0) IS NOT TRUE""",
    "outcome_label": f"""WITH {_FOLLOWED}
        SELECT o_orderkey, CASE WHEN years < 2 AND event = 1 THEN 1 ELSE 0 END AS death_2years FROM followed""",
    "cohort_union": f"""WITH {_FOLLOWED}
        SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, death_2years FROM labelled""",
    "label_join_drop": """
        SELECT doc_id, lang, n_chars, quality FROM documents JOIN labels USING (doc_id) WHERE toxic = 0""",
    "full_left_join": """
        SELECT doc_id, quality AS death_2years, toxic,
            round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
        FROM labels LEFT JOIN embeddings ON vec_id = doc_id""",
    "dataset_summary": f"""WITH {_FOLLOWED}
        {_summary("Followed Orders", 2, "SELECT death_2years AS label FROM labelled")}
        UNION ALL {_summary("Labels", 1, "SELECT quality AS label FROM labels")}
        UNION ALL {_summary("Labelled Documents", 3,
            "SELECT quality AS label FROM documents JOIN labels USING (doc_id)")}""",
    "display_names": """
        SELECT DISTINCT p_brand, p_type, replace(p_type, ' ', '_') AS feature FROM part""",
    "csv_roundtrip": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
            o_totalprice AS inferred_price FROM orders""",
    "study_registry": f"""WITH
        rows AS (SELECT c_custkey AS key, CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_nationkey % 4 = 0 AS INTEGER) END AS label
            FROM customer)
        {_summary("Clinical1", 2, "SELECT label FROM rows WHERE key % 2 = 0")}
        UNION ALL {_summary("Clinical2", 2, "SELECT label FROM rows WHERE key % 2 = 1")}
        UNION ALL {_summary("Clinical Joined", 2, "SELECT label FROM rows")}
        UNION ALL {_summary("Image Features", 1, "SELECT 1 AS label FROM rows WHERE key % 3 = 0")}
        UNION ALL {_summary("Full Data", 3, "SELECT label FROM rows")}""",
    "first_file": """
        SELECT l_orderkey AS series_id, lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS file_name, l_linenumber AS frame
        FROM lineitem
        QUALIFY l_partkey = min(l_partkey) OVER (PARTITION BY l_orderkey)""",
    "quoted_csv": """
        SELECT doc_id, source, length(nullif(text, '')) AS n, md5(nullif(text, '')) AS digest FROM documents""",
    "raw_csv": """
        SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_acctbal AS age_at_histology_x,
            c_name || ' said "yes",' || chr(10) || ' then left' AS note,
            CASE WHEN c_nationkey % 3 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS "weight_",
            CASE WHEN c_nationkey % 4 <> 0 THEN c_mktsegment END AS market_segment,
            'age_at_histology_x, weight_' AS numeric_columns
        FROM customer""",
}
