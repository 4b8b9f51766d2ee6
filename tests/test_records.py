"""Cleaning and cohort operators on small tables with the awkward cases."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.operators import assemble, cleaning, cohort
from cohortline.plans import jobs
from cohortline.sources import catalogue, registry, tables


def test_headers_are_normalised_in_order(spark):
    df = spark.createDataFrame(
        [("a", "b", "c", "d")],
        [" Overall.Stage ", "%GG", "Tumor Location (choice=RUL)", "Weight (lbs)"],
    )
    assert cleaning.clean_names(df).columns == [
        "overall_stage", "gg", "tumor_location_rul", "weight_lbs",
    ]


def test_colliding_headers_are_rejected(spark):
    df = spark.createDataFrame([(1, 2)], ["A B", "a.b"])
    with pytest.raises(ValueError, match="a_b"):
        cleaning.clean_names(df)


def test_dropping_an_absent_column_fails(spark):
    with pytest.raises(KeyError):
        cleaning.drop_columns(spark.range(1), ["nope"])


FIRST = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "PatientID", "age", "clinical.T.Stage", "Clinical.N.Stage", "Clinical.M.Stage",
            "Overall.Stage", "Histology", "Survival.time", "deadstatus.event",
        )
    ]
)


def first_rows(spark):
    return spark.createDataFrame(
        [
            ("p1", "60", "1", "2", "0", "IIIb", "large cell", "100", "1"),  # dead early
            ("p2", "61", "NA", "4", "0", "I", "adeno", "1000", "1"),  # dead late, N4
            ("p3", "62", "2", "1", "0", None, "nos", "100", "0"),  # alive, short: dropped
            ("p4", "63", "2", "", "0", "II", "nos", None, "0"),  # unknown survival: kept
            ("p5", "64", "2", "0", "0", "II", None, "100", None),  # unknown event: kept
            ("p6", None, "2", "0", "0", "IV", "nos", "900", "0"),  # unlisted stage
        ],
        FIRST,
    )


def test_first_table(spark):
    rows = {r["patient_id"]: r for r in cohort.clean_first_table(first_rows(spark)).collect()}
    assert sorted(rows) == ["p1", "p2", "p4", "p5", "p6"]
    assert [rows[p]["death_2years"] for p in sorted(rows)] == [1, 0, 0, 0, 0]
    assert rows["p1"]["overall_stage"] == 3 and rows["p1"]["histology"] == "large_cell"
    assert rows["p2"]["clinical_t_stage"] == -1 and rows["p2"]["clinical_n_stage"] is None
    assert rows["p4"]["clinical_n_stage"] == -1
    assert "survival_time" not in rows["p1"].asDict()


SECOND_COLUMNS = [
    "Case ID", "Patient affiliation", "Age at Histological Diagnosis", "Weight (lbs)", "%GG",
    "Pathological T stage", "Pathological N stage", "Pathological M stage",
    "Histopathological Grade", "Pleural invasion (elastic, visceral, or parietal)",
    "Smoking status", "Pack Years", "EGFR mutation status", "KRAS mutation status", "Histology ",
    "Ethnicity", "Date of Last Known Alive", "CT Date", "Days between CT and surgery",
    "Survival Status", "Survival Time", "Recurrence", "Recurrence Location",
    "ALK translocation status", "Tumor Location (choice=L Lingula)",
    "Tumor Location (choice=Unknown)", "Date of Recurrence", "Quit Smoking Year",
    "Date of Death", "Time to Death (days)", "PET Date",
]


def second_rows(spark):
    def row(pid, gg, t, n, m, grade, smoke, packs, egfr, kras, hist, eth, last, ct, off, status, time):
        base = [pid, "VA", "70", "150", gg, t, n, m, grade, "Yes", smoke, packs, egfr, kras]
        return tuple(
            [*base, hist, eth, last, ct, off, status, time] + ["no"] * 7 + [None, None, None]
        )

    data = [
        row("R1", ">0 - 25%", "T1a", "N0", "M1b", "G1 Well differentiated", "Nonsmoker", "N/A",
            "Wildtype", "Unknown", "NSCLC NOS (not otherwise specified)", "Asian",
            "1/11/1994", "1/1/1993", "10", "Dead", None),
        row("R2", "Not Assessed", "Tis", "N2", "M0", "G3 Poorly differentiated", "Current", "30",
            None, None, "Adeno carcinoma", "Caucasian", None, "1/1/1993", "0", "Alive", "800"),
        row("R3", "100%", "T9", "N1", "M0", "Not collected", "Former", None, "Mutant", "Wildtype",
            "Other", "Hispanic/Latino", "2/1/1993", "1/1/1993", "0", "Alive", "5000"),
        row("R4", None, "T4", "Not Recorded In Database", "M0", None, "Former", "5", "Mutant",
            "Mutant", "Other", "African-American", None, "1/1/1993", "0", "Dead", None),
    ]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in SECOND_COLUMNS])
    return spark.createDataFrame(data, schema)


def test_second_table(spark):
    rows = {r["patient_id"]: r for r in cohort.clean_second_table(second_rows(spark)).collect()}
    # R3 is alive with a short derived follow-up; its recorded time is not looked at.
    assert sorted(rows) == ["R1", "R2", "R4"]
    first, second, last = rows["R1"], rows["R2"], rows["R4"]
    assert (first["gg_percentage"], first["clinical_t_stage"], first["clinical_m_stage"]) == (1, 1, 2)
    assert first["pack_years"] == 0.0 and first["histology"] == "nos"
    assert first["ethnicity"] == "other" and first["gene_mutation"] == "yes"
    assert first["death_2years"] == 1
    assert second["gg_percentage"] == -1 and second["gene_mutation"] == "no"
    assert second["death_2years"] == 0 and second["histology"] == "adeno_carcinoma"
    assert last["clinical_n_stage"] == -1 and last["overall_stage"] == -1
    assert last["death_2years"] == 0  # dead, but when is unknown
    assert "survival_time" not in first.asDict() and "ct_date" not in first.asDict()


def test_unlisted_codes_are_reported(spark):
    found = {(r["column_name"], r["value"], r["n"]) for r in cohort.unlisted_codes(second_rows(spark)).collect()}
    assert found == {("clinical_t_stage", "t9", 1)}


def test_union_and_datasets(spark, tmp_path):
    root = str(tmp_path)
    jobs.clean_records(first_rows(spark), second_rows(spark), root)
    features = spark.createDataFrame(
        [("p1", 1.5, 1), ("R1", 2.5, 1)], "patient_id string, volume double, death_2years int"
    )
    tables.write_table(features, f"{root}/image_features")
    datasets = registry.study_datasets(spark, root)
    full = registry.open_dataset(datasets, "full_data")
    assert full.count() == 8 and full.filter("volume IS NOT NULL").count() == 2
    assert full.columns.count("death_2years") == 1
    summary = {r["dataset"]: r for r in jobs.datasets_report(datasets).collect()}
    assert summary["Clinical Joined"]["observations"] == 8
    assert summary["Clinical Joined"]["percent_positive"] == "25.0%"
    assert summary["Full Data"]["n_features"] == summary["Clinical Joined"]["n_features"] + 1
    with pytest.raises(KeyError, match="unknown dataset"):
        registry.open_dataset(datasets, "other")


def catalogue_rows(spark):
    return spark.createDataFrame(
        [
            ("a", "SEG", "a/seg", 1),  # no CT
            ("b", "SEG", "b/seg", 2), ("b", "CT", "b/ct", 3),  # eligible
            ("c", "SEG", "c/seg", 4), ("c", "CT", "c/ct1", 5), ("c", "CT", "c/ct2", 6),
            ("d", "CT", "d/ct", 7),
            ("e", "SEG", "e/seg2", 9), ("e", "SEG", "e/seg1", 8), ("e", "CT", "e/ct", 10),
        ],
        ["Subject ID", "Modality", "File Location", "at"],
    )


def test_eligibility_and_first_series(spark):
    rows = catalogue.tagged_union({"dataset1": catalogue_rows(spark)})
    eligible = cohort.eligible_subjects(rows)
    assert sorted(r[0] for r in eligible.collect()) == ["b", "e"]
    first = catalogue.series_of(eligible, catalogue.first_series(rows, ["at"], "base"))
    paths = {(r["Subject ID"], r["Modality"]): r["path"] for r in first.collect()}
    assert paths["e", "SEG"] == "base/dataset1/e/seg1"
    assert paths["b", "CT"] == "base/dataset1/b/ct"


def test_slices_follow_the_text_order(spark):
    names = ["1-1", "1-2", "1-10", "1-9"]
    files = spark.createDataFrame([("s", n) for n in names], ["series_id", "file_name"])
    placed = catalogue.slice_order(files).orderBy("z").collect()
    assert [r["file_name"] for r in placed] == ["1-1", "1-10", "1-2", "1-9"]


def test_trailing_chunks_may_be_empty(spark):
    df = spark.createDataFrame([(k, 100 - k) for k in range(13)], ["id", "at"])
    sizes = cohort.assign_chunks(df, "id", "at", 12).groupBy("chunk").count().collect()
    assert {r["chunk"]: r["count"] for r in sizes} == {**dict.fromkeys(range(1, 7), 2), 7: 1}


def test_strict_scan_fails_on_bad_cells(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    (tmp_path / "bad.csv").write_text("a,b\n1,x\noops,y\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, path, schema).collect()
    loose = tables.infer_types(tables.read_csv(spark, path))
    assert dict(loose.dtypes) == {"a": "string", "b": "string"}


def test_label_join_multiplies_repeats(spark):
    features = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], ["id", "f"])
    labels = spark.createDataFrame([("a", 1), ("a", 0), ("b", None)], "id string, y int")
    assert assemble.join_label(features, labels, "id", "y").count() == 4


def test_raw_file_with_quotes_dots_and_breaks(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        'Patient.ID,clinical.T.Stage,Age,Note\nP1,N/A,50,"he said ""no"",\nthen left"\nP2,2,51.5,\n'
    )
    raw = tables.read_csv(spark, str(tmp_path / "raw.csv"))
    clean = tables.infer_types(cleaning.clean_names(raw))
    assert clean.dtypes == [("patient_id", "string"), ("clinical_t_stage", "double"), ("age", "double"), ("note", "string")]
    assert sorted(map(tuple, clean.collect())) == [
        ("P1", None, 50.0, 'he said "no",\nthen left'),
        ("P2", 2.0, 51.5, None),
    ]
    tables.write_csv(raw, str(tmp_path / "again"))
    assert sorted(tables.read_csv(spark, str(tmp_path / "again")).collect()) == sorted(raw.collect())
    left = cleaning.recode_leftovers(raw, {"1": "1"}, ["clinical.T.Stage"]).collect()
    assert [tuple(r) for r in left] == [("clinical.T.Stage", "2", 1)]


def test_unread_dates_stop_the_job(spark, tmp_path):
    second = second_rows(spark)
    name = next(c for c in second.columns if cleaning.clean_name(c) == "ct_date")
    odd = second.withColumn(name, F.lit("the 3rd of May"))
    with pytest.raises(ValueError, match="3rd of May"):
        jobs.clean_records(first_rows(spark), odd, str(tmp_path))


def test_dates_in_several_formats(spark):
    from cohortline.functions.scalars import parse_date

    df = spark.createDataFrame([("2001-02-03",), ("2/3/2001",), ("junk",), (None,)], "d string")
    found = [r[0] for r in df.select(parse_date("d")).collect()]
    assert found == [datetime.date(2001, 2, 3)] * 2 + [None, None]


def test_display_helpers(spark):
    from cohortline.functions.scalars import display_name, feature_name, percent

    row = spark.range(1).select(
        display_name(F.lit("clinical_joined")),
        feature_name(F.lit("numeric__age")),
        feature_name(F.lit("age")),
        percent(F.lit(0.12345)),
    )
    assert list(row.first()) == ["Clinical Joined", "age", "age", "12.3%"]
