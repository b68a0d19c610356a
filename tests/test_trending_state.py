"""Trending state costs one read, one write and one timer per title and batch, however many windows it has."""

from types import SimpleNamespace

from marquee.streaming.trending import LATE_BOUND_SECONDS, TrendingProcessor


class _State:
    def __init__(self):
        self.value, self.reads, self.writes = None, 0, 0

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.writes += 1
        self.value = value


def _processor(timers):
    state = _State()
    handle = SimpleNamespace(getValueState=lambda *_: state, registerTimer=timers.append)
    processor = TrendingProcessor("tconst", 900, 900)
    processor.init(handle)
    return processor, state


def _at(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def test_one_access_per_title_and_batch():
    timers = []
    processor, state = _processor(timers)
    starts = [k * 900_000 for k in range(500)]
    (opened,) = processor.handleInputRows((1,), iter([(1, starts, [k % 3 + 1 for k in range(500)])]), _at(0))
    assert (state.reads, state.writes, len(timers)) == (1, 1, 1)
    assert opened["starts"] == starts and opened["live"][:4] == [True, True, True, False]
    shift = (LATE_BOUND_SECONDS - 900) * 1000
    (closed,) = processor.handleExpiredTimer((1,), _at(starts[400] - shift), SimpleNamespace(getExpiryTimeInMs=lambda: timers[0]))
    assert closed["starts"] == starts[:400] and closed["live"] == opened["live"][:400] and closed["kind"] == "closed"
    assert (state.reads, state.writes) == (2, 2) and timers[1:] == [starts[400] + 900_000 - shift]
    late, more = processor.handleInputRows((1,), iter([(1, [0, starts[450]], [7, 5])]), _at(starts[400] - shift))
    assert (late["kind"], late["starts"], late["votes"]) == ("late", [0], [7])
    assert more["starts"] == starts[450:] and more["votes"][0] == 6
