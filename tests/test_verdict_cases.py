"""Cases that the fixture does not hold: keyless input, other column orders, unlabelled rows, ties."""

import pytest
from pyspark.sql import functions as F

from respondry.operators import decisions, evaluation, risk, segments
from respondry.sources import derived, tables


def test_content_keys_do_not_depend_on_partitions(spark, sf_dir):
    table = derived.contact_table(spark, sf_dir).drop("contact_id")
    table = table.union(table.limit(7))
    found = [sorted(tables.with_row_key(table.repartition(n), "k").collect()) for n in (1, 4, 7)]
    assert found[0] == found[1] == found[2]
    assert len({row["k"] for row in found[0]}) == table.count()


def test_header_decides_which_column_is_which(spark, sf_dir, tmp_path):
    raw = tables.dotted_names(derived.contact_table(spark, sf_dir).drop("contact_id")).limit(20)
    turned = raw.select(*[F.col(f"`{c}`") for c in reversed(raw.columns)])
    tables.write_contacts_csv(turned, str(tmp_path / "turned"))
    back = tables.read_contacts_csv(spark, str(tmp_path / "turned"))
    assert sorted(map(str, back.collect())) == sorted(map(str, tables.normalize_names(raw).collect()))
    tables.write_contacts_csv(raw.drop("age"), str(tmp_path / "short"))
    with pytest.raises(ValueError, match="age"):
        tables.read_contacts_csv(spark, str(tmp_path / "short"))


def test_files_of_different_orders_are_read_together(spark, sf_dir, tmp_path):
    raw = tables.dotted_names(derived.contact_table(spark, sf_dir).drop("contact_id")).limit(40).cache()
    rows = sorted(map(str, tables.normalize_names(raw).collect()))
    names = [f"`{c}`" for c in raw.columns]
    half = F.pmod(F.xxhash64(F.struct("*")), F.lit(2))
    tables.write_contacts_csv(raw.where(half == 0).select(*names), str(tmp_path / "in" / "a"))
    turned = raw.where(half == 1).select(*names[::-1])
    turned.coalesce(1).write.options(**tables.CSV_OPTIONS, compression="gzip").csv(str(tmp_path / "in" / "b"))
    (tmp_path / "in" / "b" / "empty.csv").write_text("")
    back = tables.read_contacts_csv(spark, str(tmp_path / "in" / "*"))
    assert sorted(map(str, back.collect())) == rows
    tables.write_contacts_csv(raw.withColumnRenamed("age", "years"), str(tmp_path / "in" / "c"))
    with pytest.raises(ValueError, match=r"in/c/part.*missing \['age'\].*years"):
        tables.read_contacts_csv(spark, str(tmp_path / "in" / "*"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    nothing = tables.read_contacts_csv(spark, str(tmp_path / "none"), unreadable="bad")
    assert nothing.isEmpty() and nothing.columns == [*back.columns, "bad"]


def test_unreadable_lines_are_shown(spark, sf_dir, tmp_path):
    raw = tables.dotted_names(derived.contact_table(spark, sf_dir).drop("contact_id")).limit(3)
    tables.write_contacts_csv(raw.coalesce(1), str(tmp_path / "csv"))
    file = next((tmp_path / "csv").glob("part*.csv"))
    lines = file.read_text().splitlines()
    cells = lines[1].split(";")
    cells[lines[0].split(";").index("age")] = "forty"
    file.write_text("\n".join([lines[0], ";".join(cells), *lines[2:], "half;a;line"]) + "\n")
    next((tmp_path / "csv").glob(".part*.crc")).unlink()
    rows = tables.read_contacts_csv(spark, str(tmp_path / "csv"), unreadable="bad").collect()
    assert [r["bad"] for r in rows] == [";".join(cells), None, None, "half;a;line"]
    assert rows[0]["age"] is None and rows[1]["age"] is not None


def test_rows_without_label_or_score_are_left_out(spark):
    nan = float("nan")
    known = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.7), (0.0, 0.1)]
    extra = [(None, 0.99), (1.0, None), (0.0, nan)]
    areas = []
    for rows in (known, known + extra):
        frame = spark.createDataFrame(rows, "label double, p_yes double")
        areas.append(evaluation.curve_areas(evaluation.outcome_counts(frame)).first())
    assert areas[0] == areas[1]


def test_percentages_round_the_exact_value(spark):
    values = [0.0, 1.0, 0.5, 0.10125, 0.10375, 0.00125, 0.12345, 1 / 3, 0.99999, 0.00005, 0.295, 0.03125, 0.015625]
    values += [i / 1600 for i in range(1, 1600, 37)] + [i / 3200 for i in range(1, 3200, 91)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    shown = {r["i"]: r["s"] for r in frame.select("i", decisions.percentage(F.col("p")).alias("s")).collect()}
    assert [shown[i] for i in range(len(values))] == [f"{v * 100:.2f}%" for v in values]
    odd = spark.createDataFrame([(None,), (float("nan"),)], "p double")
    assert [r[0] for r in odd.select(decisions.percentage(F.col("p"))).collect()] == [None, None]


def test_a_part_of_the_table_scores_as_in_the_whole(spark, sf_dir):
    table = segments.segment_customers(derived.scored(spark, sf_dir))
    labels = risk.outcome_labels(table)
    whole = risk.assess_risk(table, labels).where("pdays < 120").select("contact_id", "churn_risk_score")
    part = risk.assess_risk(table.where("pdays < 120"), labels).select("contact_id", "churn_risk_score")
    assert whole.exceptAll(part).isEmpty()
    with pytest.raises(ValueError):
        risk.assess_risk(table)
