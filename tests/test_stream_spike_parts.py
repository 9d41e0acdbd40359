"""The stream's spike check gives rows back part by part, so what is carried never gathers in the worker."""

import pandas as pd

from pointgate.streaming.spikes import _SpikeProcessor


class Kept:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def part(rows):
    frame = pd.DataFrame(rows, columns=["spike_order0", "spike_value0", "carried0"])
    return frame.assign(spike_absent0=frame["spike_value0"].isna())


def test_parts_come_back_as_they_arrived():
    processor = _SpikeProcessor([(0, 50.0)], 0.5, 1, 1, None)
    processor.state = Kept()
    parts = [part([(4, 10.0, "e"), (0, 10.0, "a")]), part([(3, 200.0, "d"), (1, 20.0, "b"), (2, None, "c")])]
    got = list(processor.handleInputRows(("k",), iter(parts), None))
    assert [list(g["carried0"]) for g in got] == [["e", "a"], ["d", "b", "c"]]
    flat = pd.concat(got).set_index("carried0")
    assert flat["__hit_metric"].notna().to_dict() == {"e": False, "a": False, "d": True, "b": False, "c": False}
    assert flat.loc["d", "__hit_delta"] == 185.0 and flat.loc["d", "__hit_baseline"] == 15.0
    assert processor.state.value == ([12.5],)
