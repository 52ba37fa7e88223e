"""CSV files with line feeds in cells, against pandas, at several split sizes."""

import io
import random

import pandas as pd
import pytest

from tallyspark.sources import csvrecords
from tallyspark.sources.raw import malformed_rows, scan_csv

COLUMNS = ["id", "name", "note"]


def make(seed, eol, n=60):
    """CSV text with quoted line feeds, doubled quotes, stray quotes, blank lines and long cells."""
    rng = random.Random(seed)
    cells = ["plain", "", "two words", "5\" pipe", '"a ""quoted"" word"', f'"first{eol}second"', f'"{eol}"', '","', f'"x, y{eol}{eol}z""{eol}"', "end\"", '"long ' + "l" * 120 + f'{eol}er"', "é ü", '""']
    out = ["id,name,note"]
    for i in range(n):
        out.append(f"{i},{rng.choice(cells)},{rng.choice(cells)}")
        if rng.random() < 0.1:
            out.append("")
    return eol.join(out) + (eol if rng.random() < 0.5 else "")


def by_pandas(text):
    df = pd.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False, na_values=[])
    return [tuple(r) for r in df.itertuples(index=False)]


@pytest.fixture
def split_size(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_records_equal_pandas(spark, tmp_path, split_size, size, eol):
    texts = [make(s, eol) for s in (1, 2)]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.csv").write_bytes(t.encode())
    split_size(size)
    got = [tuple((v or "") for v in (r.id, r.name, r.note)) for r in scan_csv(spark, str(tmp_path), COLUMNS).orderBy("_ord").collect()]
    assert got == [r for t in texts for r in by_pandas(t)]
    if size == 37:
        found = csvrecords.survey(spark, str(tmp_path))
        assert found.count() > 30 and csvrecords.starts(found).where("begin").count() > 5


def test_states_of_lines():
    for line, start, end in [('a,b', False, False), ('a,"b', False, True), ('b",c', True, False), ('a,b"c', False, False), ('"a""', False, True), ('"a""",b', False, False), ('""",x', False, True),
                             ('x""y', True, True), ('x"",y",z', True, False), ('"a" b"c', False, False), ('"a","', False, True), ('', True, True), ('"",""', False, False)]:
        assert csvrecords.ends_inside(line, start) is end, line
    assert [csvrecords.fields(r) for r in ("", "a,b", '"a,b",c', '"a""",",",x', 'a"b,c"')] == [1, 2, 2, 3, 2]


def test_rows_with_too_many_cells_are_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,a,b\n2,a,b,c\n3,"x,\ny",z\n4,only\n')
    with pytest.raises(Exception, match="more than 3 cells"):
        scan_csv(spark, str(tmp_path), COLUMNS).collect()
    kept = scan_csv(spark, str(tmp_path), COLUMNS, malformed="drop").orderBy("_ord").collect()
    assert [(r.id, r.name, r.note) for r in kept] == [("1", "a", "b"), ("3", "x,\ny", "z"), ("4", "only", None)]
    assert [(r.cells, r.record) for r in malformed_rows(spark, str(tmp_path)).collect()] == [(4, "2,a,b,c")]
    (tmp_path / "b.csv").write_text('id,note,name\n1,a,"b\n"\n')
    with pytest.raises(ValueError, match="another header"):
        scan_csv(spark, str(tmp_path), COLUMNS, malformed="drop")
