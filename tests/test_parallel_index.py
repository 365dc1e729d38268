"""Both routes of the frame index give the same rows, for any chunking."""

import struct

import pytest

from dumpkit import SCALED_FIELDS, acquisition, fast_values, stream
from strobe.sources.dumps import decode_index, index_chunks, list_chunks, write_chunks
from strobe.sources.parallel_index import index_archive_files, index_chunks_parallel

COLS = ["conn_id", "kind", "acq_no", "frame_no", "pos", "n_bytes", "first_sample", "n_rows", "layout", "process",
        "samples", "reason", "message", "pieces"]


def _streams():
    good = stream(
        acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
        acquisition(SCALED_FIELDS, fast_values(20), [3, 17], end=("Data overrun", 20)),
        acquisition(SCALED_FIELDS, fast_values(5), [5], end=None),
    )
    bad_marker = good.replace(b"BIN ", b"BAD ", 4)  # fourth frame marker corrupted
    first = good.find(b"BIN ")
    partial = bytearray(good)
    partial[first + 4 : first + 8] = struct.pack("<I", 8 + 52 * 10 + 3)  # not whole records
    garbage = good.replace(b"END 58 Ok\n", b"END 58 Ok\nnoise line\n<head>\n", 1)
    return {0: good, 1: bad_marker, 2: bytes(partial), 3: garbage}


def _rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.select(*COLS).collect()))


def _archive(spark, root, streams, cut):
    rows = []
    for conn, data in streams.items():
        at = 0
        for i, n in enumerate(cut(len(data))):
            rows.append((conn, i, data[at : at + n]))
            at += n
    write_chunks(spark.createDataFrame(rows, "conn_id long, chunk_no long, data binary"), root).collect()
    return list_chunks(spark, root)


def _even(size):
    return lambda total: [min(size, total - o) for o in range(0, total, size)]


def _uneven(total):
    sizes = [300, 1500, 700]
    return [*sizes, total - sum(sizes)] if total > sum(sizes) else [total]


def _samples(spark, index):
    dec = decode_index(index)
    names = [x for x in dec.columns if x != "process"]
    return sorted(tuple(map(str, r)) for r in dec.select(*[f"`{x}`" for x in names]).collect())


@pytest.mark.parametrize(("cut", "block"), [(_even(61), 700), (_even(333), 64), (_even(4096), 1 << 20), (_uneven, 333)], ids=["61", "333", "4096", "uneven"])
def test_index_routes_give_the_same_rows(spark, tmp_path, cut, block):
    listing = _archive(spark, str(tmp_path / "arch"), _streams(), cut)
    seq = index_chunks(listing)
    routed = index_archive_files(listing, walk_bytes=0, block_bytes=block)
    assert _rows(routed) == _rows(seq)
    assert {"frame", "header", "end", "reject"} <= {r[1] for r in _rows(seq)}
    assert _samples(spark, routed) == _samples(spark, seq)


def _awkward():
    """Streams that break in every way the protocol can."""
    good = _streams()[0]
    head = good.index(b"<header>")
    out = {
        0: good[3:],  # no OK line
        1: b"OK" + good[2:].replace(b"OK\n", b"", 1),
        2: b"no line end at all",
        3: good[: len(good) // 2],
        4: good[: good.rindex(b"</header>") + 4],  # ends inside a header
        5: good.replace(b"</header>\n\n", b"</header>\nX", 1),  # no newline behind the header
        6: good.replace(b"sample_bytes=", b"sample_bytez=", 1),  # a header that cannot be read
        7: good.replace(b"END 58 Ok\n", b"END 58 Never heard\n", 1),
        8: good.replace(b"END 58 Ok\n", b"END x Ok\n", 1),
        9: good[: good.rindex(b"BIN ") + 6],
        10: good.replace(b"BIN ", b"abc\n", 1),  # a bad marker that ends a line
        11: good[:head] + b"<header>\n" * 3 + good[head:],
        12: good.replace(b"END 58 Ok\n", b"END 58 Ok\nBIN \x08\x00\x00\x00END \n" + b"<header>" * 20 + b"\n", 1),
        13: b"OK\n",
        14: good[:head] + b"junk " * 20_000 + b"\n" + good[head:],
        15: good.replace(b"BIN ", b"BIN \x08\x00\x00\x00BIN ", 1),  # a frame without records
        16: good.replace(b"BIN ", b"BIN \x07\x00\x00\x00", 1),
    }
    first = good.find(b"BIN ")
    for k, wrong in ((17, 8 + 520 + 52 * 2 + 1), (18, 1 << 30), (19, 8 + 521)):
        out[k] = good[: first + 4] + struct.pack("<I", wrong) + good[first + 8 :]
    return out


@pytest.mark.parametrize(("cut", "block"), [(_even(997), 512), (_uneven, 4096), (_even(7000), 100)])
def test_broken_streams_give_the_rows_of_the_walk(spark, tmp_path, cut, block):
    listing = _archive(spark, str(tmp_path / "arch"), _awkward(), cut)
    assert _rows(index_archive_files(listing, walk_bytes=0, block_bytes=block)) == _rows(index_chunks(listing))


def test_chunks_in_memory_keep_their_payloads(spark):
    data = _streams()[1]
    rows = [(5, i, data[o : o + 97]) for i, o in enumerate(range(0, len(data), 97))]
    chunks = spark.createDataFrame(rows, "conn_id long, chunk_no long, data binary")
    names = ["kind", "acq_no", "frame_no", "pos", "n_bytes", "first_sample", "payload"]
    got = index_chunks_parallel(chunks, 640).select(names).collect()
    assert sorted(map(str, got)) == sorted(map(str, index_chunks(chunks).select(names).collect()))


def test_clean_streams_need_no_second_walk(spark, tmp_path):
    clean = {k: v for k, v in _streams().items() if k in (0, 3)}
    listing = _archive(spark, str(tmp_path / "arch"), clean, _even(333))
    assert _rows(index_chunks_parallel(listing, 2000)) == _rows(index_chunks(listing))


def test_long_text_between_acquisitions_loses_nothing(spark, tmp_path):
    data = _streams()[0]
    junk = b"".join(b"ignored line %d\n" % i for i in range(8000))
    wordy = data.replace(b"END 58 Ok\n", b"END 58 Ok\n" + junk, 1)
    blanks = data.replace(b"<fields>\n", b"<fields>\n" + b" " * 70_000 + b"\n", 1)
    assert len(junk) > 100_000
    listing = _archive(spark, str(tmp_path / "arch"), {0: wordy, 1: blanks, 2: data}, _even(5000))
    rows = index_archive_files(listing, walk_bytes=0, block_bytes=9000).collect()
    assert not [r for r in rows if r.kind == "reject"]
    for conn in (0, 1, 2):
        own = [r for r in rows if r.conn_id == conn]
        assert sum(r.kind == "header" for r in own) == 3 and sum(r.n_rows or 0 for r in own if r.kind == "frame") == 83


def test_walk_goes_on_at_the_next_header(spark, tmp_path):
    listing = _archive(spark, str(tmp_path / "arch"), _streams(), _even(1000))
    rows = index_chunks(listing).collect()
    for conn in (1, 2):
        own = [r for r in rows if r.conn_id == conn]
        assert sum(r.kind == "header" for r in own) == 3
        (reject,) = [r for r in own if r.kind == "reject"]
        after = min(r.pos for r in own if r.kind == "header" and r.pos > reject.pos)
        assert reject.pos + reject.n_bytes == after and reject.acq_no == 1


def test_conversion_lists_what_it_could_not_read(spark, tmp_path):
    from strobe.operators.convert import convert_archive

    root = str(tmp_path / "arch")
    _archive(spark, root, {0: _streams()[0], 1: _streams()[1]}, _even(1000))
    done = convert_archive(spark, root, str(tmp_path / "out"), check_overrun=False)
    (reject,) = done.rejects.collect()
    assert reject.conn_id == 1 and reject.lost_bytes == done.lost_bytes > 0
    assert done.samples == 83 + 25  # of connection 1 the acquisitions behind the reject
    with pytest.raises(ValueError, match="unreadable"):
        convert_archive(spark, root, str(tmp_path / "out2"), check_overrun=False, fail_on_rejects=True)


def test_mixed_archive_routes_per_connection(spark, tmp_path):
    data = _streams()[0]
    rows = [(0, i, data[o : o + 100]) for i, o in enumerate(range(0, len(data), 100))]
    rows += [(1, 0, data[:900]), (1, 1, data[900:1500])]
    root = str(tmp_path / "arch")
    write_chunks(spark.createDataFrame(rows, "conn_id long, chunk_no long, data binary"), root).collect()
    listing = list_chunks(spark, root)
    mixed = _rows(index_archive_files(listing, walk_bytes=2000, block_bytes=1000))  # conn 0 parallel, conn 1 walked
    assert mixed == _rows(index_chunks(listing))


@pytest.mark.parametrize("size", [61, 100_000])
def test_walk_reads_headers_and_markers_alone(size):
    from strobe.sources.dumps import _Cursor, _walk

    data = stream(*[acquisition(SCALED_FIELDS, fast_values(500), [250, 250], end=("Ok", 500)) for _ in range(400)])
    cut = [data[o : o + size] for o in range(0, len(data), size)]
    cursor = _Cursor((i, len(c), "", c) for i, c in enumerate(cut))
    rows = list(_walk(0, cursor, with_payload=False))
    heads = sum(len(r["header"]) for r in rows if r["kind"] == "header")
    assert sum(r["kind"] == "frame" for r in rows) == 800
    assert cursor.bytes_read < 2 * heads + 400 * 512 < len(data)
