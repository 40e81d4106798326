"""The derived change stream and the queries over it against SQL."""

import os

import duckdb
import pytest

from weirline.plans import queries as q
from weirline.plans import stream as st


def _sql(sf, text):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    out = con.sql(text)
    return out.columns, out.fetchall()


def _same(frame, sf, text):
    columns, want = _sql(sf, text)
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("width", [7, 100, 65_536])
def test_rows_are_numbered_alike_in_slices_of_any_width(spark, sf, monkeypatch, width):
    monkeypatch.setattr(st, "SLICE", width)
    got = st.stream(spark, sf).select("event_id", "p", "offset", "seq", "batch_start", "serial_group", "serial_seq")
    _same(got, sf, st.SQL + 'SELECT event_id, p, "offset", seq, batch_start, serial_group, serial_seq FROM s')


@pytest.mark.parametrize("block", [1, 2, 65_536])
def test_files_follow_from_the_counts(spark, sf, monkeypatch, block):
    monkeypatch.setattr(st, "FILES_A_BLOCK", block)
    columns = "serial_group, p, seq, serial_seq, start_offset, end_offset, n_rows, epoch_ms, sealed_at_ms"
    _same(st.files(spark, sf).select(*columns.split(", ")), sf, f"{st.SQL}SELECT {columns} FROM files")
    _same(st.ledger(spark, sf).select("identifier", "status"), sf, st.SQL + "SELECT identifier, status FROM ledger")


def test_no_events_no_files(spark, sf, monkeypatch):
    whole = st.table
    monkeypatch.setattr(st, "table", lambda s, d, n: whole(s, d, n).limit(0))
    assert st.files(spark, sf).count() == st.stream(spark, sf).count() == 0


@pytest.mark.parametrize("name", ["str_1_rotation", "src_6_catalog_columns", "agg_2_file_ranges", "str_9_gate"])
def test_query_equals_its_sql(spark, sf, name):
    _same(q.QUERIES[name](spark, sf), sf, q.ORACLE[name])
