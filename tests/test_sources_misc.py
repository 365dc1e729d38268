"""State-file text source and stage chains."""

from pyspark.sql import functions as F

from dumpkit import SCALED_FIELDS, acquisition, chunks_df, fast_values, stream
from strobe.operators.stages import by_kind
from strobe.operators.state import segment_statements, statement_rows
from strobe.sources.dumps import index_chunks
from strobe.sources.statefiles import read_state_files, write_state_files

SAVE = ["Attr=0", "Config=0", "SingleLineMeta1=0", "SingleLineMeta2=0", "Table<B", "tabledata", "",
        "MultiLineMeta1<", "multimetadata1", "", "MultiLineMeta2<", "multimetadata2", ""]


def test_state_file_roundtrip(spark, tmp_path):
    src = tmp_path / "saves"
    src.mkdir()
    (src / "a.sav").write_text("\n".join(SAVE) + "\n")
    (src / "b.sav").write_text("X=1\nY<\n1\n2\n\n")
    lines = read_state_files(spark, str(src))
    a = [r["line"] for r in lines.where(F.col("file").endswith("a.sav")).orderBy("line_no").collect()]
    assert a == SAVE
    rows = statement_rows(segment_statements(lines, ["file"]), ["file"])
    assert rows.count() == 7 + 2
    out = str(tmp_path / "out")
    write_state_files(lines.withColumn("device", F.regexp_extract("file", r"(\w)\.sav$", 1)).drop("file"), ["device"], out)
    back = read_state_files(spark, out + "/device=a")
    assert [r["line"] for r in back.orderBy("line_no").collect()] == SAVE


def test_state_file_of_many_splits(spark, tmp_path):
    src = tmp_path / "large"
    src.mkdir()
    want = [f"F{i}=" + "x" * (i % 90) for i in range(4000)] + ["", "last without a newline"]
    (src / "a.sav").write_text("\n".join(want))
    (src / "empty.sav").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = read_state_files(spark, str(src))
        got = [(r["line_no"], r["line"]) for r in lines.orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate(want))


def test_stage_chains_by_kind(spark):
    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)))
    index = index_chunks(chunks_df(spark, data, 100))
    out = by_kind(index, {
        "frame": [lambda df: df.where(F.col("n_rows") > 10), lambda df: df.select("frame_no")],
        "end": [lambda df: df.select("samples", "reason")],
    })
    assert [r[0] for r in out["frame"].collect()] == [1]
    assert [tuple(r) for r in out["end"].collect()] == [(58, "Ok")]
