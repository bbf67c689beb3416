"""Tag-line scan and stop tags (FIXTURES H1, H2)."""

from canopus.config import VectorizeConfig
from canopus.functions.stopwords import DEFAULT_STOP_TERMS, spark_full_match, stop_pattern
from canopus.sources.tags import parse_tag_lines, tag_tokens


def _parse(spark, lines, cfg=VectorizeConfig()):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r["doc_id"]: list(r["tags"]) for r in parse_tag_lines(df, cfg).collect()}


def test_field_count_rule(spark):
    tags48 = "|".join(f"t{i}" for i in range(48))
    tags49 = "|".join(f"t{i}" for i in range(49))
    got = _parse(spark, [f"a|{tags48}", f"b|{tags49}", f"c|{tags48}|||"])
    assert "a" not in got                      # 49 fields
    assert got["b"] == [f"t{i}" for i in range(48)]  # 50 fields, last one dropped
    assert "c" not in got                      # trailing empty fields vanish


def test_all_stop_tags_kept_as_empty_doc(spark):
    line = "d|" + "|".join(["dv"] * 49)
    assert _parse(spark, [line]) == {"d": []}


def test_lowercase_and_order(spark):
    cfg = VectorizeConfig(min_fields=1)
    got = _parse(spark, ["x|B|a|B|c|LAST"], cfg)
    assert got == {"x": ["b", "a", "b", "c"]}


def test_stop_tags_full_match(spark):
    dropped = ["", "优酷", "优酷原创", "dv", "dvnull", "2012", "2012年"]
    kept = ["原创优酷", "nulldv", "travel", "12012"]
    cfg = VectorizeConfig(min_fields=1, drop_last_field=False)
    got = _parse(spark, ["id|" + "|".join(dropped + kept) + "|end"], cfg)
    assert got["id"] == kept + ["end"]


def test_pattern_is_anchored(spark):
    from pyspark.sql import functions as F
    pat = spark_full_match(stop_pattern(DEFAULT_STOP_TERMS))
    df = spark.createDataFrame([("abc",), ("",), ("null",)], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", F.col("t").rlike(pat).alias("m")).collect()}
    assert got == {"abc": False, "": True, "null": True}


def test_tokens_positions(spark):
    cfg = VectorizeConfig(min_fields=1, drop_last_field=False)
    df = spark.createDataFrame([("7|x||y",)], "value string")
    rows = sorted((r["pos"], r["tag"]) for r in tag_tokens(parse_tag_lines(df, cfg)).collect())
    assert rows == [(0, "x"), (1, "y")]


def test_fields_are_split_once(spark):
    """Inside a WHEN Spark evaluates repeated expressions again: the split has to stand there once."""
    for cfg in (VectorizeConfig(), VectorizeConfig(sep=";;", drop_last_field=False)):
        df = parse_tag_lines(spark.createDataFrame([("a",)], "value string"), cfg, drop_short=False)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_separators_and_case(spark):
    """The number of fields, whatever the separator is and lower-casing does to it."""
    keep = VectorizeConfig(min_fields=1, drop_last_field=False)
    for sep, line in (("|", "x|A||B"), (";;", "x;;A;;;;B"), ("\t", "x\tA\t\tB"), ("||", "x||A||||B")):
        assert _parse(spark, [line], keep.with_(sep=sep)) == {"x": ["a", "b"]}
        assert _parse(spark, [line + sep + "C"], keep.with_(sep=sep, drop_last_field=True)) == {"x": ["a", "b"]}
    assert _parse(spark, ["1zAzBzC"], keep.with_(sep="z")) == {"1": ["a", "b", "c"]}
    assert _parse(spark, ["1ZaZb"], keep.with_(sep="Z")) == {"1": ["azb"]}   # lower-cased before it is split


def test_own_stop_terms(spark):
    cfg = VectorizeConfig(min_fields=1, drop_last_field=False, stop_terms=("", "𝒶b", "the", "th"), drop_years=False)
    assert _parse(spark, ["1||𝒶b|𝒶|the|theth|ththe|th|2012|b|zz"], cfg) == {"1": ["𝒶", "ththe", "2012", "b", "zz"]}
    none = cfg.with_(stop_terms=())
    assert _parse(spark, ["1||a|2012|zz"], none) == {"1": ["a", "2012", "zz"]}
