from respondry.operators.decisions import decide
from respondry.plans import application, preparation
from respondry.sources import derived, tables


def test_from_raw_contacts_to_reports(spark, sf_dir, tmp_path):
    out = str(tmp_path)
    csv = f"{out}/contacts.csv"
    raw = derived.contact_table(spark, sf_dir)
    tables.write_contacts_csv(tables.dotted_names(raw), csv)
    raw = tables.read_contacts_csv(spark, csv, key="contact_id")
    fitted, built = application.build(raw, out, num_trees=(4,), max_depths=(2, 3))
    assert {r["split"] for r in built["evaluation"].collect()} == {"val", "test"}
    assert built["grid"].count() == 2 and built["feature_importance"].count() == 15

    test = tables.read_table(spark, f"{out}/test")
    sizes = {(r["split"], r["is_synthetic"]): r["count"] for r in built["split_sizes"].collect()}
    assert test.count() == sizes[("test", False)]
    assert tables.read_table(spark, f"{out}/train").count() == (
        sizes[("train", False)] + sizes[("train", True)]
    )

    reports = application.report(test, fitted.forest, out)
    rows = {name: df.collect() for name, df in reports.items()}
    total = test.count()
    assert sum(r["count"] for r in rows["segment_stats"]) == total
    assert sum(r["customer_count"] for r in rows["risk_summary"]) == total
    assert sum(r["count"] for r in rows["risk_counts"]) == total
    assert sum(r["count"] for r in rows["risk_marginals"]) == 3 * total
    assert len(rows["top_at_risk"]) >= 50
    assert len(rows["risk_correlation"]) == 36 and len(rows["strategies"]) == 3

    again = application.Models.load(spark, f"{out}/models")
    scored = preparation.score_contacts(
        raw.drop("y"), again.cleaning, again.features, again.forest
    )
    assert decide(scored).count() == raw.count()


def test_inferred_and_explicit_schemas_agree(spark, sf_dir, tmp_path):
    path = str(tmp_path / "contacts.csv")
    raw = derived.contact_table(spark, sf_dir)
    tables.write_contacts_csv(tables.dotted_names(raw), path)
    explicit = tables.read_contacts_csv(spark, path, key="contact_id")
    keyless = explicit.drop("contact_id")
    keyed = tables.with_row_key(keyless, "contact_id")
    assert keyed.select("contact_id").distinct().count() == raw.count()
    inferred = tables.read_contacts_csv(spark, path, infer=True)
    assert explicit.columns == inferred.columns == raw.columns
    same = inferred.select(*[inferred[f.name].cast(f.dataType) for f in explicit.schema.fields])
    assert explicit.exceptAll(same).isEmpty()
    assert tables.read_table(spark, f"{sf_dir}/customer.parquet", 3).rdd.getNumPartitions() == 3
