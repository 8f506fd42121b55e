import pytest
from ledgerline.functions import vocab
from ledgerline.sources import bulk


@pytest.mark.parametrize("schema, names", [
    (bulk.schedule_b_schema, vocab.SCHEDULE_B_DEFAULT_COLUMNS),
    (bulk.schedule_e_schema, vocab.SCHEDULE_E_DEFAULT_COLUMNS),
    (bulk.schedule_a_schema, vocab.SCHEDULE_A_DEFAULT_COLUMNS),
])
def test_files_without_header_are_read_by_the_default_columns(spark, workdir, schema, names):
    cells = [[f'{row} "{k}' for k in range(len(names))] for row in range(3)]
    spark.createDataFrame([("|".join(c),) for c in cells], "value string").write.text(f"{workdir}/files")
    df = bulk._pipe_reader(spark, schema(spark), "UTF-8").csv(f"{workdir}/files")
    assert df.columns == list(names) and sorted(map(list, df.collect())) == cells


def test_schedule_a_without_header(spark, workdir):
    names = list(vocab.SCHEDULE_A_DEFAULT_COLUMNS)
    assert len(names) == 78
    spark.createDataFrame([("|".join(f"v{k}" for k in range(78)),)], "value string").coalesce(1).write.text(f"{workdir}/landing")
    import glob
    import os

    os.makedirs(f"{workdir}/files")
    with open(glob.glob(f"{workdir}/landing/part-*")[0]) as part, open(f"{workdir}/files/itcont_2024.txt", "w") as out:
        out.write(part.read())
    row = bulk.load_schedule_a_raw(spark, f"{workdir}/files", [2024]).first().asDict()
    for k, (_, name) in enumerate(bulk.canonical_schedule_a_columns(names)):
        if name != "two_year_transaction_period":
            assert row[name] == f"v{k}"


def test_landed_line_has_every_column(spark):
    """cells that no row has are put down together; the line is the same."""
    from pyspark.sql import functions as F

    from ledgerline.plans.roundtrip_queries import _in_columns, _line

    rows = spark.createDataFrame([(1, None, "x"), (None, "", "y")], "b int, d string, z string")
    for columns in (["a", "b", "c", "c2", "d", "e"], ["b", "d"], ["q", "r"], ["d"], ["d", "q"]):
        cells = _in_columns(rows, columns)
        old = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
        assert rows.select(_line(rows, columns).alias("v")).collect() == cells.select(old.alias("v")).collect(), columns
