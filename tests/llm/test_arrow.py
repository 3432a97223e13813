import pyarrow as pa

from tidebook.llm.arrow import whole_groups


def test_groups_of_more_than_2_gb_stay_whole():
    part = pa.RecordBatch.from_arrays([pa.array([7] * 3), pa.array([bytes(1 << 28)] * 3, pa.binary())], ["token", "bitmap"])
    last = pa.RecordBatch.from_arrays([pa.array([8]), pa.array([b"x"], pa.binary())], ["token", "bitmap"])
    got = [(rows.num_rows, rows.column("token")[0].as_py()) for rows in whole_groups([part, part, part, last], "token")]
    assert got == [(9, 7), (1, 8)]
