from pyspark.sql import functions as F

from fixed_values import LINES, STOP_NAMES
from quayflow.functions.texts import normalise_name, strip_space
from quayflow.operators.reference import identify_lines, observed_lines, select_roi_stops
from quayflow.plans.references import line_reference, stop_reference
from quayflow.sources.tables import lines_csv, stops_csv


def test_line_rules(spark):
    lines = spark.createDataFrame([(line[0],) for line in LINES], "line_id string")
    assert [tuple(row) for row in identify_lines(lines).collect()] == LINES


def test_stop_rules(spark):
    rows = [
        (f"FR::monomodalStopPlace:{1000 + i}:FR1", name, "railStation", "Paris")
        for i, (name, _, _) in enumerate(STOP_NAMES)
    ]
    rows.append(("FR::monomodalStopPlace:1:FR1", "Châtelet", "railStation", "Paris"))
    schema = "id string, name string, stop_type string, town string"
    candidates = spark.createDataFrame(rows, schema)
    result = {row.id: row for row in stop_reference(candidates).collect()}
    assert len(result) == len(STOP_NAMES)
    for i, (name, normalised, station) in enumerate(STOP_NAMES):
        row = result[f"FR::monomodalStopPlace:{1000 + i}:FR1"]
        assert (row.name, row.name_norm, row.roi_station) == (name, normalised, station)
        assert row.stop_numeric_id == str(1000 + i)
        assert row.siri_monitoring_ref == f"STIF:StopPoint:Q:{1000 + i}:"


def test_station_match_edges(spark):
    stops = spark.createDataFrame(
        [("Fort d'Aubervilliers",), ("Auber - La Défense",), (None,), ("",)], "name string"
    )

    def matches(**options):
        rows = select_roi_stops(stops, **options).collect()
        return sorted((row.name, row.roi_station) for row in rows)

    both = [("Auber - La Défense", "AUBER"), ("Auber - La Défense", "LA_DEFENSE")]
    assert matches() == [*both, ("Fort d'Aubervilliers", "AUBER")]
    assert matches(whole_words=True) == both


def test_normalise_name_folds_all_latin_letters(spark):
    texts = ["Ÿ ế Ǻ Ž ñ İ", "été", "Œuvre ß", "  --  ", None]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    rows = df.select("i", normalise_name(F.col("t")).alias("n")).orderBy("i").collect()
    assert [row.n for row in rows] == ["y e a z n i", "ete", "uvre", "", None]


def test_strip_space_equals_python(spark):
    texts = ["  a b  ", "\x1c\ta\x1f", "a\n\n", " 　 ", "​a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_space(F.col("t"))).collect()] == [
        t.strip() for t in texts
    ]


def test_observed_lines_ignore_null_and_case(spark):
    lines = identify_lines(spark.createDataFrame([(line[0],) for line in LINES], "line_id string"))
    seen = [(LINES[0][2],), (LINES[0][2],), (LINES[1][2].lower(),), (None,), (LINES[2][2][:-1],)]
    passages = spark.createDataFrame(seen, "line_ref string")
    assert [row.line_id for row in observed_lines(lines, passages).collect()] == [LINES[0][0]]
    assert line_reference(lines.select("line_id"), passages).count() == 1


def test_csv_sources(spark, tmp_path):
    lines = tmp_path / "lines.csv"
    lines.write_text(
        "short_name,line_id,operator_ref\n7,FR1:Line:C1:,\"{'version': 'any', 'ref': 'x'}\"\n",
        encoding="utf-8",
    )
    row = lines_csv(spark, str(lines)).collect()[0]
    assert (row.short_name, row.operator_ref) == ("7", "{'version': 'any', 'ref': 'x'}")
    stops = tmp_path / "stops.csv"
    stops.write_text('id,name\n1,"La ""Défense""\nNord"\n', encoding="utf-8")
    assert stops_csv(spark, str(stops)).collect()[0].name == 'La "Défense"\nNord'
