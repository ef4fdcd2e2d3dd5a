"""Edge cases and properties of the operators on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerspark.config import SeriesConfig
from ledgerspark.functions import (
    concat_lenient, concat_strict, extract_response, is_numeric_text, normalise_error_text, round_money,
    text_to_double, to_int_code,
)
from ledgerspark.functions.codes import warehouse_name
from ledgerspark.functions.text import BLANK_MESSAGE_WARNING
from ledgerspark.operators import control, metrics, recon, series, sqlrun, textprep, validate

D = dt.datetime


def _key(t):
    return tuple((x is None, str(x)) for x in t)


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=_key)


# ---- functions ---------------------------------------------------------------------------------

def test_numeric_text_rules(spark):
    vals = [("12.5",), (" 12 ",), ("inf",), ("-Infinity",), ("nan",), ("1,000",), ("1d",), ("",), (None,), ("1e3",)]
    df = spark.createDataFrame(vals, "v string")
    out = dict(df.select("v", is_numeric_text("v").alias("ok"), text_to_double("v").alias("x")).rdd
               .map(lambda r: (r.v, (r.ok, r.x))).collect())
    assert out["12.5"] == (True, 12.5)
    assert out[" 12 "] == (True, 12.0)
    assert out["inf"][0] and out["inf"][1] == float("inf")
    assert out["-Infinity"][0]
    for bad in ("nan", "1,000", "1d", ""):
        assert out[bad] == (False, None)
    assert out[None] == (False, None)
    assert out["1e3"] == (True, 1000.0)


def test_error_text_and_concat_rules(spark):
    df = spark.createDataFrame([(None, "a"), ("", None), (" ", "b"), ("  ", "c"), ("boom", "d")], "m string, p string")
    out = df.select(normalise_error_text("m").alias("e"), concat_strict(F.lit("x"), "p").alias("s"),
                    concat_lenient(F.lit("x"), "p").alias("l")).collect()
    assert [r.e for r in out] == [None, "Unknown", "Unknown", "Unknown", "boom"]
    assert [r.s for r in out] == ["xa", None, "xb", "xc", "xd"]
    assert [r.l for r in out] == ["xa", "x", "xb", "xc", "xd"]


def test_codes_round_and_cast(spark):
    df = spark.createDataFrame([("0018", 2.675), ("0006", 1.005), ("0021", -0.125), ("abc", 0.0), ("9999", 1.0)],
                               "c string, x double")
    out = df.select(warehouse_name("c").alias("n"), to_int_code("c").alias("i"), round_money("x").alias("r")).collect()
    assert [r.n for r in out] == ["Gyal", "Rawa", "Romania", None, None]
    assert [r.i for r in out] == [18, 6, 21, None, 9999]
    assert [r.r for r in out] == [2.68, 1.01, -0.13, 0.0, 1.0]


def test_response_extraction(spark):
    df = spark.createDataFrame([("no marker  ",), ("### Response:  hi \n",), ("a ### Response: x ### Response:\ty\n",)],
                               "t string")
    assert [r.x for r in df.select(extract_response("t").alias("x")).collect()] == ["no marker  ", "hi", "y"]


# ---- SQL over frames ---------------------------------------------------------------------------

def test_run_sql_and_counts(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, g string")
    assert sqlrun.df_count(spark, "SELECT count(*) AS count FROM a WHERE g = 'x'", a=a) == 2
    assert sqlrun.count_records(a) == 3
    out = sqlrun.run_sql(spark, "SELECT g, count(*) AS n FROM a WHERE k > :k GROUP BY g", args={"k": 1}, a=a)
    assert rows(out) == [("x", 1), ("y", 1)]


# ---- validation --------------------------------------------------------------------------------

CFG = SeriesConfig("Product", "Date", "Amount", "MS")


def test_validation_flags_and_split(spark):
    raw = spark.createDataFrame([
        ("p", "2020-01-05", "10"),
        (None, "2020-01-05", "10"),
        ("p", "bad", "10"),
        ("p", "2020-01-05", None),
        ("p", "2020-01-05", "nan"),
        ("p", "05/01/2020", "1,000"),
        ("p", "2020-01-05 10:00:00", " 12 "),
    ], "Product string, Date string, Amount string")
    clean, errors, members = validate.validate_split(raw, CFG)
    flags = sorted(r.Error_Flag for r in errors.collect())
    assert flags == sorted(["Missing Product; ", "Invalid Date; ", "Missing Amount; Non-numeric Amount; ",
                            "Non-numeric Amount; ", "Invalid Date; Non-numeric Amount; "])
    assert rows(clean, "Amount") == [(10.0,), (12.0,)]
    assert "Error_Flag" not in clean.columns
    assert rows(members) == [("p",)]
    # bad dates become NULL in the error rows
    assert errors.filter(F.col("Error_Flag").contains("Invalid")).filter(F.col("Date").isNotNull()).count() == 0


def test_reshape_wide_keeps_nulls_and_checks_columns(spark):
    cols = ["a", "b", "Material", "c", "d", "e", "f", "g", "h", "2020-01-01", "2020-02-01"]
    df = spark.createDataFrame([tuple(["x"] * 9 + [1.0, None])], ", ".join(f"`{c}` " + ("string" if i < 9 else "double")
                                                                           for i, c in enumerate(cols)))
    long = validate.reshape_wide(df)
    assert rows(long) == [("x", "2020-01-01", 1.0), ("x", "2020-02-01", None)]
    with pytest.raises(ValueError, match="Material"):
        validate.reshape_wide(df.drop("Material"))
    with pytest.raises(ValueError, match="No date columns"):
        validate.reshape_wide(df.select(*[f"`{c}`" for c in cols[:9]]))


def test_clean_metrics_drops_nonfinite(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0, 5.0), ("m", float("inf"), 1.0, 5.0), ("m", 1.0, 1.0, float("nan")),
                                ("m", 1.0, 1.0, None)], "Model string, RMSE double, MAE double, `MAPE (%)` double")
    assert validate.clean_metrics(df).count() == 1
    assert validate.nonfinite_metrics_to_null(df).filter(F.col("RMSE").isNull()).count() == 1
    only = df.select("Model")
    assert validate.clean_metrics(only).count() == 4


# ---- series ------------------------------------------------------------------------------------

def _long(spark):
    data = [("a", D(2020, 1, 5), 1.0), ("a", D(2020, 1, 20), 2.0), ("a", D(2020, 4, 2), 4.0),
            ("b", D(2021, 6, 1), 7.0), (None, D(2020, 1, 1), 100.0)]
    return spark.createDataFrame(data, "Product string, Date timestamp_ntz, Amount double")


def test_resample_fills_gaps_and_keeps_totals(spark):
    res = series.resample(_long(spark), CFG)
    assert rows(res, "Product", "Date", "Amount") == [
        ("a", D(2020, 1, 1), 3.0), ("a", D(2020, 2, 1), 0.0), ("a", D(2020, 3, 1), 0.0), ("a", D(2020, 4, 1), 4.0),
        ("b", D(2021, 6, 1), 7.0)]
    totals = dict(res.groupBy("Product").agg(F.sum("Amount")).collect())
    assert totals == {"a": 7.0, "b": 7.0}


def test_history_filter_and_split_partition_rows(spark):
    cfg = SeriesConfig("Product", "Date", "Amount", "MS", min_history=3, test_size=2)
    prep = series.prepare(_long(spark), cfg)
    assert rows(prep, "Product", "split") == [("a", "test"), ("a", "test"), ("a", "train"), ("a", "train")]
    cfg_all = SeriesConfig("Product", "Date", "Amount", "MS", min_history=1, test_mode=False)
    assert series.prepare(_long(spark), cfg_all).filter(F.col("split") != "train").count() == 0


def test_windows_scale_inverse_and_future_axis(spark):
    cfg = SeriesConfig("Product", "Date", "Amount", "MS", min_history=1, test_mode=False, window_size=2)
    res = series.split_holdout(series.resample(_long(spark), cfg), cfg)
    win = series.supervised_windows(res, cfg)
    assert rows(win.filter(F.col("Product") == "a"), "X", "y") == [([0.0, 0.0], 4.0), ([3.0, 0.0], 0.0)]
    sc = series.minmax_scale(res, cfg)
    back = sc.select("Amount", series.minmax_inverse(F.col("scaled"), F.col("_min"), F.col("_max")).alias("r"))
    assert all(abs(r.Amount - r.r) < 1e-9 for r in back.filter(F.col("Product") == "a").collect())
    assert rows(sc.filter(F.col("Product") == "b"), "scaled") == [(0.0,)]  # constant series -> 0
    last = spark.createDataFrame([("a", D(2020, 11, 1))], "Product string, last_date timestamp_ntz")
    fut = series.future_axis(last, cfg, horizon=3)
    assert rows(fut, "k", "Date") == [(1, D(2020, 12, 1)), (2, D(2021, 1, 1)), (3, D(2021, 2, 1))]


def test_recursive_forecast(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "h array<double>")
    out = df.select(series.recursive_forecast(F.col("h"), F.array(F.lit(0.5), F.lit(1.0)), F.lit(1.0), 3).alias("f"))
    # y3 = 1 + 0.5*1 + 1*2 = 3.5 ; y4 = 1 + 0.5*2 + 3.5 = 5.5 ; y5 = 1 + 0.5*3.5 + 5.5 = 8.25
    assert out.first().f == [3.5, 5.5, 8.25]


def test_metrics_zero_actual_gives_null_mape(spark):
    df = spark.createDataFrame([("s", 2.0, 1.0), ("s", 4.0, 5.0), ("z", 0.0, 1.0), ("z", 2.0, 2.0)],
                               "k string, actual double, predicted double")
    out = {r.k: r for r in metrics.score(df, ["k"]).collect()}
    assert out["s"].MAE == 1.0 and abs(out["s"].RMSE - 1.0) < 1e-12
    assert abs(out["s"]["MAPE (%)"] - 37.5) < 1e-9
    assert out["z"]["MAPE (%)"] is None


# ---- joins, sets, latest -----------------------------------------------------------------------

def test_reconcile_equals_two_left_joins(spark):
    wms = spark.createDataFrame([("k1", "p1"), ("k1", "p2"), ("k2", None), (None, "p9"), ("k1", "p1")],
                                "wms_key string, wms_palletID string")
    ax = spark.createDataFrame([("k1", "A1"), ("k3", "A3"), (None, "A0")], "ax_key string, ax_palletID string")
    got = rows(recon.reconcile(wms, ax))
    wms.createOrReplaceTempView("w")
    ax.createOrReplaceTempView("x")
    want = rows(spark.sql("""
        SELECT w.*, x.* FROM w LEFT JOIN x ON x.ax_key = w.wms_key
        UNION SELECT w.*, x.* FROM x LEFT JOIN w ON x.ax_key = w.wms_key"""))
    assert got == want


def test_union_variants(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "k int, v string")
    assert recon.union_all(a, b).count() == a.count() + b.count()
    assert recon.union_distinct(a, b).count() == 3
    c = spark.createDataFrame([("7", 1.5)], "k string, w double")
    out = recon.union_by_name(a, c)
    assert dict(out.dtypes)["k"] == "string"
    assert rows(out.filter(F.col("w").isNotNull()), "k", "v") == [("7", None)]


def test_latest_by_breaks_ties(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), 10), (1, D(2020, 2, 1), 11), (1, D(2020, 2, 1), 12),
                                (2, D(2019, 1, 1), 20)], "c int, d timestamp_ntz, o int")
    assert rows(recon.latest_by(df, "c", ["d", "o"]), "c", "o") == [(1, 12), (2, 20)]


# ---- control -----------------------------------------------------------------------------------

def test_control_windows_and_upsert(spark):
    as_of = D(2024, 2, 1, 6)
    logs = spark.createDataFrame([("s1", D(2024, 1, 1), D(2024, 1, 1, 1), dt.date(2024, 1, 1), "Completed", "full"),
                                  ("s1", D(2024, 1, 2), D(2024, 1, 2, 1), dt.date(2024, 1, 2), "Completed", "full")],
                                 "script_name string, start_datetime timestamp_ntz, end_datetime timestamp_ntz, "
                                 "rundate date, status string, load_type string")
    scripts = spark.createDataFrame([("s1",), ("s2",)], "script_name string")
    w = {r.script_name: r for r in control.load_windows(logs, scripts, as_of).collect()}
    assert w["s1"].date_from == D(2024, 1, 2, 1) and w["s1"].load_type == "incremental"
    assert w["s2"].date_from == D(2024, 2, 1) - dt.timedelta(days=6000) and w["s2"].load_type == "full"
    assert control.date_range(30, as_of) == (D(2024, 1, 2), as_of)
    runs = control.history_rows(control.load_windows(logs, scripts, as_of))
    up = control.upsert_run_log(logs, runs.withColumn("status", F.lit("Done")))
    got = rows(up, "script_name", "status", "load_type")
    assert got == [("s1", "Done", "incremental"), ("s1", "Done", "incremental"), ("s2", "Done", "full")]


# ---- text prep ---------------------------------------------------------------------------------

def test_pairs_vocabulary_tokenize(spark):
    conv = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "b c"), (1, 2, "user", "lonely"),
                                  (2, 0, "system", "s"), (2, 1, "user", "b"), (2, 2, "assistant", None)],
                                 "conv_id bigint, turn bigint, role string, text string")
    pairs = textprep.pair_turns(conv)
    ok, bad = textprep.training_texts(pairs)
    assert ok.count() == 1 and rows(bad, "reason") == [("Missing response",)]
    texts = spark.createDataFrame([(1, "b a b"), (2, "c b"), (3, "")], "id int, text string")
    vocab = textprep.build_vocabulary(texts, "id")
    assert rows(vocab, "token", "token_id") == [("a", 1), ("b", 0), ("c", 2)]
    tok = {r.id: r for r in textprep.tokenize(texts, vocab, "id", max_length=2).collect()}
    assert tok[1].input_ids == [0, 1] and tok[2].input_ids == [2, 0]
    assert tok[3].input_ids == [3, 3] and tok[3].attention_mask == [0, 0]
    assert tok[1].labels == tok[1].input_ids
    msgs = spark.createDataFrame([("hi",), ("  ",), (None,)], "text string")
    out = textprep.chat_prompts(msgs).collect()
    assert out[0].prompt == "### Instruction: hi\n### Response:" and out[0].reply is None
    assert out[1].prompt is None and out[1].reply == BLANK_MESSAGE_WARNING and out[2].reply == BLANK_MESSAGE_WARNING


@pytest.mark.parametrize("freq,expected", [
    ("h", [(D(2020, 1, 1, 0), 1.0), (D(2020, 1, 1, 1), 0.0), (D(2020, 1, 1, 2), 2.0)]),
    ("QS", [(D(2020, 1, 1), 1.0), (D(2020, 4, 1), 0.0), (D(2020, 7, 1), 2.0)]),
    ("YS", [(D(2020, 1, 1), 1.0), (D(2021, 1, 1), 0.0), (D(2022, 1, 1), 2.0)]),
])
def test_resample_other_frequencies(spark, freq, expected):
    cfg = SeriesConfig("Product", "Date", "Amount", freq, min_history=1, test_mode=False)
    last = {"h": D(2020, 1, 1, 2, 30), "QS": D(2020, 8, 15), "YS": D(2022, 3, 1)}[freq]
    df = spark.createDataFrame([("a", D(2020, 1, 1, 0, 10), 1.0), ("a", last, 2.0)],
                               "Product string, Date timestamp_ntz, Amount double")
    assert rows(series.resample(df, cfg), "Date", "Amount") == expected


def test_unsupported_frequency_and_zero_test_size_raise():
    with pytest.raises(ValueError, match="unsupported freq"):
        SeriesConfig("a", "b", "c", "W")
    with pytest.raises(ValueError, match="test_size"):
        SeriesConfig("a", "b", "c", "MS", test_size=0)


def test_numeric_rule_agrees_with_pandas(spark):
    """R4's numeric check and conversion against pandas.to_numeric (the
    reference's own rule) on generated text."""
    import random

    import pandas as pd
    rng = random.Random(7)
    alphabet = list("0123456789.eE+- ,infatyINFd_\t\n")
    texts = {"1", " 12 ", "\t12\n", "inf", "-inf", " inf ", "Infinity", "nan", "1,000", "1d", "", "1e5", "1e",
             ".5", "5.", ".", "+", "1_000", "1e309", "-1e309", "2e-400", "+.5e-3", "1.2.3"}
    while len(texts) < 1500:
        texts.add("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))))
    texts = sorted(texts)
    got = {r.t: (r.ok, r.x) for r in spark.createDataFrame([(t,) for t in texts], "t string")
           .select("t", is_numeric_text("t").alias("ok"), text_to_double("t").alias("x")).collect()}
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    for t, w in zip(texts, want):
        ok, x = got[t]
        assert ok == bool(pd.notna(w)), repr(t)
        if ok:
            assert x == w, repr(t)


def test_strip_and_extraction_agree_with_python(spark):
    """python_strip / extract_response against str.strip() and str.split()."""
    import random

    from ledgerspark.functions.text import python_strip
    rng = random.Random(3)
    pieces = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", " ", "　", "a", "é",
              "### Response:", "x y"]
    texts = sorted({"".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(800)})
    got = {r.t: (r.s, r.e) for r in spark.createDataFrame([(t,) for t in texts], "t string")
           .select("t", python_strip("t").alias("s"), extract_response("t").alias("e")).collect()}
    for t in texts:
        want_e = t.split("### Response:")[-1].strip() if "### Response:" in t else t
        assert got[t] == (t.strip(), want_e), repr(t)


def test_upsert_without_matching_script_changes_nothing(spark):
    logs = spark.createDataFrame([("s1", D(2024, 1, 1), D(2024, 1, 1, 1), dt.date(2024, 1, 1), "Completed", "full")],
                                 "script_name string, start_datetime timestamp_ntz, end_datetime timestamp_ntz, "
                                 "rundate date, status string, load_type string")
    runs = spark.createDataFrame([("other", D(2024, 2, 1), D(2024, 2, 1, 1), dt.date(2024, 2, 1), "Completed",
                                   "incremental")], logs.schema)
    assert rows(control.upsert_run_log(logs, runs)) == rows(logs)


def test_round_money_is_wide_and_rounds_once(spark):
    from pyspark.sql import functions as F

    from ledgerspark.functions.numeric import round_money
    row = spark.range(1).select(round_money(F.lit(1.23456), 4).alias("a"), round_money(F.lit(1e17)).alias("b"),
                                round_money(F.lit(0.1249999999)).alias("c"), round_money(F.lit(0.125)).alias("d")).first()
    assert tuple(row) == (1.2346, 1e17, 0.12, 0.13)


def test_hour_bins_ignore_the_session_zone(spark):
    from pyspark.sql import functions as F

    from ledgerspark.functions.dates import bin_start
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = F.lit("2021-03-14 02:30:15").cast("timestamp_ntz")
        got = spark.range(1).select(*[bin_start(t, f).cast("string").alias(f) for f in ("h", "D", "MS", "QS", "YS")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert list(got) == ["2021-03-14 02:00:00", "2021-03-14 00:00:00", "2021-03-01 00:00:00", "2021-01-01 00:00:00", "2021-01-01 00:00:00"]


def test_run_sql_leaves_no_views(spark):
    from ledgerspark.operators import sqlrun
    spark.range(3).createOrReplaceTempView("shadowed_frame")
    assert sqlrun.run_sql(spark, "SELECT count(*) AS n FROM shadowed_frame", shadowed_frame=spark.range(5)).first().n == 5
    assert spark.table("shadowed_frame").count() == 3
    sqlrun.run_sql(spark, "SELECT * FROM only_here", only_here=spark.range(1))
    assert not spark.catalog.tableExists("only_here")


def test_vocabulary_ids_do_not_depend_on_exchange_reuse(spark):
    """Ids are 0..V-1 also when Spark evaluates the range partitioning more than once."""
    from ledgerspark.operators import textprep
    texts = spark.range(3000).selectExpr("id", "concat_ws(' ', transform(sequence(0, 9), i -> concat('t', pmod(hash(id, i), 20000)))) AS text")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ids = [r.token_id for r in textprep.build_vocabulary(texts, "id").collect()]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted(ids) == list(range(len(ids)))


def test_tokenize_head_and_rest_of_the_vocabulary_agree(spark, monkeypatch):
    """Tokens of the broadcast head and of the shuffled rest get the same ids as in one join."""
    from ledgerspark.operators import textprep
    texts = spark.createDataFrame([(1, "a a a b c"), (2, "b a d"), (3, ""), (4, None)], "id int, text string")
    rows = lambda: sorted(map(str, textprep.tokenize(texts, textprep.build_vocabulary(texts, "id"), "id").collect()))
    whole = rows()
    monkeypatch.setattr(textprep, "HEAD_TOKENS", 2)
    assert rows() == whole


def test_gap_fill_is_linear_runs_of_zeros(spark):
    """Gaps of any length are filled with 0; positions and length count every bin; a null sum is 0."""
    import datetime as dt

    from ledgerspark.config import SeriesConfig
    from ledgerspark.operators import series
    d = lambda m: dt.datetime(2020, m, 15)
    df = spark.createDataFrame([("x", d(1), 1.0), ("x", d(4), 2.0), ("x", d(4), 3.0), ("y", d(2), None), ("x", None, 9.0)],
                               "`a b` string, t timestamp_ntz, v double")
    out = series.resample(df, SeriesConfig("a b", "t", "v", "MS", min_history=1, test_mode=False)).collect()
    assert sorted((r["a b"], r.t.month, r.v, r.period_idx, r.n_periods) for r in out) == [
        ("x", 1, 1.0, 0, 4), ("x", 2, 0.0, 1, 4), ("x", 3, 0.0, 2, 4), ("x", 4, 5.0, 3, 4), ("y", 2, 0.0, 0, 1)]
