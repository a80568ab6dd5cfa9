import numpy as np
import pytest

from segscore.plans import recipes as R
from segscore.plans import reference_table, training


def write_csv(folder, header, rows):
    folder.mkdir()
    text = [",".join(header), *(",".join(map(str, r)) for r in rows)]
    (folder / "part.csv").write_text("\n".join(text))
    return str(folder)


def test_reads_the_ratio_table_and_applies_the_fixed_drops(spark, tmp_path):
    r = np.random.default_rng(1)
    header = [" Bankrupt?", *(f" {c}" for c in R.FEATURE_LABELS), "Index "]
    rows = [[i % 2, *r.normal(size=95).round(4), i] for i in range(60)]
    df = reference_table.read_ratios(spark, write_csv(tmp_path / "t", header, rows), header)
    assert df.columns == ["id", "label", *R.FEATURE_LABELS] and df.count() == 60
    first = df.orderBy("id").first()
    assert (first["id"], first["label"]) == (0, 0) and first[R.FEATURE_LABELS[3]] == rows[0][4]
    prep = training.fit_global(df, R.FEATURE_LABELS, R.GLOBAL_DROP, R.GLOBAL_REDUCTION, R.POST_REDUCTION_DROP)
    assert not set(prep.out) & {*R.GLOBAL_DROP, *R.POST_REDUCTION_DROP}
    assert len(training.apply_global(df, prep).columns) == 2 + len(prep.out)
    types = {x["column"]: (x["type"], x["nulls"]) for x in reference_table.column_types(df).collect()}
    assert types["label"] == ("int", 0) and types[R.FEATURE_LABELS[0]] == ("double", 0)


def test_refuses_a_table_without_its_columns(spark):
    with pytest.raises(KeyError, match="Index"):
        reference_table.read_ratios(spark, "/nowhere", ["Bankrupt?", *R.FEATURE_LABELS])
