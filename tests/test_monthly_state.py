"""Mergeable monthly state against the full aggregate."""

import os

import pytest

from starload.functions.patterns import DAILY_COLUMNS
from starload.operators.monthly import monthly_aggregate
from starload.operators.monthly_state import MonthlyState
from starload.sources.daily_tsv import read_daily_tsv
from starload.sources.warehouse import CommitConflict
from tests.conftest import rows

HEAD = "\t".join(DAILY_COLUMNS)


def line(date, syndrome="S1", age="00+", dept="all", **measures):
    values = {"date": date, "syndrome": syndrome, "age_group": age, "ed_type": dept, **{k: str(v) for k, v in measures.items()}}
    return "\t".join(values.get(c, "NA") for c in DAILY_COLUMNS)


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEAD, *lines]) + "\n")


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing dir"
    put(root / "a.tsv", line("2023-01-01", relative_cases=3, ed_count=4), line("2023-01-02", relative_cases=5), line("2023-02-01", "S2", ed_count=7))
    put(root / "b.tsv", line("2023-01-03", relative_cases=10, ed_count=2), line("NA", relative_cases=99), line("2023-01-03", "NA", relative_cases=1))
    return root


def same(spark, state, path):
    assert rows(state.monthly()) == rows(monthly_aggregate(read_daily_tsv(spark, path)))


def test_state_follows_new_replaced_and_removed_files(spark, tmp_path, landing):
    path = f"{landing}/*.tsv"
    state = MonthlyState(spark, str(tmp_path / "state"))
    took = state.refresh(path)
    assert (took.version, took.read, took.removed, took.files) == (1, 2, 0, 2)
    same(spark, state, path)
    took = state.refresh(path)
    assert (took.read, took.removed, took.files) == (0, 0, 2)      # nothing new, nothing read
    same(spark, state, path)
    put(landing / "c.tsv", line("2023-01-09", relative_cases=1, ed_count=40), line("2024-05-01", "S3", expected_value=8))
    assert state.refresh(path).read == 1
    same(spark, state, path)
    put(landing / "a.tsv", line("2023-01-01", relative_cases=7))
    os.utime(landing / "a.tsv", (1_900_000_000, 1_900_000_000))
    took = state.refresh(path)
    assert (took.read, took.removed) == (1, 1)
    same(spark, state, path)
    (landing / "c.tsv").unlink()
    took = state.refresh(path)
    assert (took.read, took.removed, took.files) == (0, 1, 2)
    same(spark, state, path)
    before = rows(state.monthly())
    state.compact()
    assert rows(state.monthly()) == before and state.refresh(path).read == 0
    put(landing / "d.tsv", line("2025-01-01", ed_count=1))
    assert state.refresh(path).read == 1
    same(spark, state, path)


def test_a_changed_time_alone_counts_as_a_change(spark, tmp_path, landing):
    path = f"{landing}/*.tsv"
    state = MonthlyState(spark, str(tmp_path / "state"))
    state.refresh(path)
    put(landing / "b.tsv", line("2023-01-04", relative_cases=10, ed_count=2), line("NA", relative_cases=99), line("2023-01-03", "NA", relative_cases=1))
    os.utime(landing / "b.tsv", (1_900_000_000, 1_900_000_000))
    took = state.refresh(path)
    assert (took.read, took.removed) == (1, 1)
    same(spark, state, path)


def test_files_without_complete_rows(spark, tmp_path):
    root = tmp_path / "l"
    put(root / "a.tsv", line("NA", relative_cases=1))
    state = MonthlyState(spark, str(tmp_path / "state"))
    assert state.refresh(f"{root}/*.tsv").read == 1
    assert rows(state.monthly()) == [] and state.refresh(f"{root}/*.tsv").read == 0
    put(root / "b.tsv", line("2023-01-01", relative_cases=1), line("2023-01-01", "S2"))
    assert state.refresh(f"{root}/*.tsv").read == 1
    same(spark, state, f"{root}/*.tsv")            # a group without values keeps its row


def test_no_input_is_an_error_and_two_refreshes_conflict(spark, tmp_path, landing, monkeypatch):
    state = MonthlyState(spark, str(tmp_path / "state"))
    with pytest.raises(FileNotFoundError):
        state.refresh(f"{tmp_path}/none/*.tsv")
    stale = state.store.manifest()
    state.refresh(f"{landing}/*.tsv")
    with monkeypatch.context() as m:
        m.setattr(state.store, "manifest", lambda: stale)
        with pytest.raises(CommitConflict):
            state.refresh(f"{landing}/*.tsv")
    same(spark, state, f"{landing}/*.tsv")


def test_a_refresh_that_fails_leaves_the_state(spark, tmp_path, landing):
    path = f"{landing}/*.tsv"
    state = MonthlyState(spark, str(tmp_path / "state"))
    state.refresh(path)
    before = rows(state.monthly())
    put(landing / "c.tsv", line("no date"))
    with pytest.raises(Exception):
        state.refresh(path)
    assert state.store.current_version() == 1 and rows(state.monthly()) == before
    put(landing / "c.tsv", line("2023-03-01", relative_cases=2))
    assert state.refresh(path).read == 1
    same(spark, state, path)
