"""Rows of a stream's chunks that waited come out in frames of bounded size."""

import pandas as pd
from test_streaming import _data, _processor

from strobe.streaming import reassembly


def test_rows_of_chunks_that_waited_come_in_frames(monkeypatch):
    """The first chunk comes last and sets all others free."""
    monkeypatch.setattr(reassembly, "OUTPUT_BYTES", 4000)
    data = _data()
    p, handle, feed, _ = _processor()
    feed(*[(i, data[40 * i : 40 * (i + 1)]) for i in range(1, -(-len(data) // 40))])
    first = pd.DataFrame({"chunk_no": [0], "data": [data[:40]]})
    frames = list(p.handleInputRows((7,), iter([first]), handle))
    rows = [r for f in frames for r in f.to_dict("records")]
    assert [r["kind"] for r in rows] == [r["kind"] for r in reassembly.PushParser().feed(data)]
    assert len(frames) > 3 and max(map(len, frames)) <= 4
