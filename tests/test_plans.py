"""The physical-plan properties the scale design relies on."""

import contextlib
import io

import pytest

from marquee.plans import roles

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top10_pushes_filter_and_prunes_columns(spark):
    text = plan(roles.top10_people(spark, SF))
    assert "PushedFilters: [Or(StringContains(l_returnflag,A),StringContains(l_returnflag,R))" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in text
    assert "TakeOrderedAndProject" in text


@pytest.mark.parametrize("name", ["top3_by_person", "sliding_top3"])
def test_top_n_limits_before_the_shuffle(spark, name):
    text = plan(roles.BATCH[name](spark, SF))
    tree = text.split("\n\n")[0]
    lines = [ln.strip(" +-:") for ln in tree.splitlines()]
    limits = [i for i, ln in enumerate(lines) if ln.startswith("WindowGroupLimit")]
    exchanges = [i for i, ln in enumerate(lines) if ln.startswith("Exchange")]
    assert len(limits) == 2  # partial (map side) and final
    assert any(limits[0] < e < limits[1] for e in exchanges)


def test_key_merge_is_one_shuffle(spark):
    tree = plan(roles.merge_documents_labels(spark, SF)).split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "Join" not in tree


def test_only_size_checked_broadcast():
    """The library never forces a broadcast, except the counted one in the stream name trim.

    The optional subpackage has a counted one of its own, tested beside it (tests/llm).
    """
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "marquee"
    hits = [(p.relative_to(root).as_posix(), ln.strip()) for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts
            for ln in p.read_text().splitlines() if "F.broadcast(" in ln]
    assert hits == [("streaming/queries.py",
                     "lookup = names.join(F.broadcast(keys), names[title] == keys[title], \"left_semi\")")]
