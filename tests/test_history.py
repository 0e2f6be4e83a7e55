import datetime as dt

import pytest

from tidewire.operators import dimensions as D
from tidewire.operators import scd2 as S
from tidewire.schemas import SITE_DIMENSION
from tidewire.session import scratch_path
from tidewire.sources import tables
from tidewire.sources.tables import CoreTable

T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"
SCHEMA = "content_id string, content_type string, title string, published_at timestamp, updated_at string, record_hash string"


def batch(spark, **hashes):
    rows = [(k, "articles", f"{k}-{h}", None, None, h) for k, h in hashes.items()]
    return spark.createDataFrame(rows, SCHEMA)


def history(state):
    return sorted(
        (r.content_id, r.version, r.record_hash, r.valid_from.day, r.valid_to.year == 9999 or r.valid_to.day, r.is_current)
        for r in state.collect()
    )


EXPECTED_2 = [
    ("a", 1, "h1", 1, 2, False), ("a", 2, "h2", 2, True, True), ("b", 1, "h1", 1, True, True), ("c", 1, "h1", 2, True, True),
]
EXPECTED_3 = [
    ("a", 1, "h1", 1, 2, False), ("a", 2, "h2", 2, 3, False), ("a", 3, "h1", 3, True, True),
    ("b", 1, "h1", 1, True, True), ("c", 1, "h1", 2, True, True),
]


def test_merge_sequence(spark):
    state = S.first_versions(batch(spark, a="h1", b="h1"), T1)
    state = S.scd2_merge(state, batch(spark, a="h2", b="h1", c="h1"), T2)
    assert history(state) == EXPECTED_2
    again = S.scd2_merge(state, batch(spark, a="h2", b="h1", c="h1"), T3)
    assert history(again) == EXPECTED_2
    state = S.scd2_merge(state, batch(spark, a="h1"), T3)
    assert history(state) == EXPECTED_3
    assert S.broken_versions(state).count() == 0
    assert {r.content_pk for r in state.collect()} == {
        "a|articles|1", "a|articles|2", "a|articles|3", "b|articles|1", "c|articles|1"}
    closed = state.where("content_id = 'a' and version = 2").first()
    assert closed.updated_db_at.day == 3 and closed.created_at.day == 2 and closed.title == "a-h2"


def test_null_hash_is_a_value(spark):
    rows = [("a", "articles", "t", None, None, None)]
    first = S.first_versions(spark.createDataFrame(rows, SCHEMA), T1)
    assert S.scd2_merge(first, spark.createDataFrame(rows, SCHEMA), T2).count() == 1
    assert S.scd2_merge(first, batch(spark, a="h1"), T2).count() == 2


def test_duplicate_keys_in_a_batch_keep_the_latest(spark):
    rows = [("a", "articles", "old", None, "2026-01-01", "h1"), ("a", "articles", "new", None, "2026-01-02", "h2")]
    first = S.first_versions(batch(spark, z="h"), T1)
    merged = S.scd2_merge(first, spark.createDataFrame(rows, SCHEMA), T2, latest_by="updated_at")
    assert [r.title for r in merged.where("content_id = 'a'").collect()] == ["new"]


@pytest.mark.parametrize("buckets", [None, 4])
def test_stored_table_equals_the_pure_merge(spark, buckets):
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=buckets)
    assert core.load(batch(spark, a="h1", b="h1"), "2026-01-01", T1) == {"current": 2, "opened": 2, "closed": 0}
    assert core.load(batch(spark, a="h2", b="h1", c="h1"), "2026-01-02", T2) == {"current": 3, "opened": 2, "closed": 1}
    assert history(core.state()) == EXPECTED_2
    # the same date again: same table
    core.load(batch(spark, a="h2", b="h1", c="h1"), "2026-01-02", T2)
    assert history(core.state()) == EXPECTED_2
    core.load(batch(spark, a="h1"), "2026-01-03", T3)
    assert history(core.state()) == EXPECTED_3
    # a rerun with another batch leaves nothing of the earlier run behind
    core.load(batch(spark, b="h1"), "2026-01-03", T3)
    assert history(core.state()) == EXPECTED_2
    assert core.snapshots() == ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert core.expire_slices(keep=1) == ["2026-01-01", "2026-01-02"]
    assert history(core.state()) == EXPECTED_2


def test_load_that_breaks_off_changes_nothing(spark, monkeypatch):
    core = CoreTable(spark, scratch_path(spark, "core"))
    core.load(batch(spark, a="h1"), "2026-01-01", T1)
    core.load(batch(spark, a="h2"), "2026-01-02", T2)
    before = history(core.state())

    def broken(number, loads):
        raise OSError("lost")

    monkeypatch.setattr(core.manifest, "publish", broken)
    with pytest.raises(OSError):
        core.load(batch(spark, a="h3"), "2026-01-02", T2)
    assert history(CoreTable(spark, core.path).state()) == before


def test_two_writers_cannot_both_publish(spark):
    core = CoreTable(spark, scratch_path(spark, "core"))
    core.load(batch(spark, a="h1"), "2026-01-01", T1)
    number, loads = core.manifest.read()
    core.manifest.publish(number, loads)
    with pytest.raises(Exception):
        core.manifest.publish(number, loads)


@pytest.mark.parametrize("buckets", [None, 4])
def test_loads_in_any_order(spark, buckets):
    days = {"2026-01-01": dict(a="h1", b="h1"), "2026-01-02": dict(a="h2", b="h1", c="h1"), "2026-01-03": dict(a="h1")}
    moments = dict(zip(days, (T1, T2, T3), strict=True))
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=buckets)
    core.load(batch(spark, **days["2026-01-01"]), "2026-01-01", T1)
    core.load(batch(spark, **days["2026-01-03"]), "2026-01-03", T3)
    before = history(core.state())
    with pytest.raises(ValueError):
        core.load(batch(spark, **days["2026-01-02"]), "2026-01-02", T2)
    assert history(core.state()) == before
    again = lambda day: (batch(spark, **days[day]), moments[day])
    assert core.load(*again("2026-01-02")[:1], "2026-01-02", T2, replay=again) == {"current": 3, "opened": 2, "closed": 1}
    assert history(core.state()) == EXPECTED_3


def sites(spark, day, *names):
    rows = [(n, dt.date(2026, 2, day)) for n in names]
    return spark.createDataFrame(rows, "news_site string, ingest_date date")


def test_site_dimension(spark):
    empty = spark.createDataFrame([], SITE_DIMENSION)
    one = D.upsert_sites(empty, sites(spark, 17, "S1", "S1", "S1", "S2"), T1)
    two = D.upsert_sites(one, sites(spark, 18, "S1", "S1", "S3", "S3", "S3", "S3", "", None), T2)
    found = {
        r.news_site_name: (r.first_seen_date.day, r.last_seen_date.day, r.total_content_count, r.created_at.day, r.updated_at.day)
        for r in two.collect()
    }
    assert found == {"S1": (17, 18, 5, 1, 2), "S2": (17, 17, 1, 1, 1), "S3": (18, 18, 4, 2, 2)}
    assert [r.news_site_name for r in D.new_sites(one, sites(spark, 18, "S1", "S3")).collect()] == ["S3"]


def test_topic_dimension(spark):
    df = spark.createDataFrame([("A",), ("A",), ("",), (None,), ("B",)], "topic_name string")
    assert sorted(r.topic_name for r in D.topic_dimension(df, T1).collect()) == ["A", "B"]


def test_random_loads_against_a_plain_model(spark):
    """Four loads of random batches; the expected history is built row by row in Python."""
    import random

    random.seed(11)
    core = CoreTable(spark, scratch_path(spark, "core"))
    expected = {}
    for day in range(1, 5):
        hashes = {f"k{n}": random.choice(["x", "y", None]) for n in random.sample(range(40), 25)}
        core.load(batch(spark, **hashes), f"2026-01-0{day}", f"2026-01-0{day} 00:00:00")
        for key, value in hashes.items():
            versions = expected.setdefault(key, [])
            if versions and versions[-1][0] == value:
                continue
            if versions:
                versions[-1][2] = day
            versions.append([value, day, None])
    found = {}
    for r in core.state().collect():
        end = None if r.is_current else r.valid_to.day
        found.setdefault(r.content_id, []).append((r.version, [r.record_hash, r.valid_from.day, end]))
    assert {k: [v for _, v in sorted(vs, key=lambda v: v[0])] for k, vs in found.items()} == expected
    assert all([n for n, _ in sorted(vs, key=lambda v: v[0])] == list(range(1, len(vs) + 1)) for vs in found.values())
    assert S.broken_versions(core.state()).count() == 0


def files(core):
    """(load date, is_current, bucket) of every folder with data files."""
    import pathlib

    found = pathlib.Path(core.path.removeprefix("file:")).glob("load_id=*/is_current=*/bucket=*/*.parquet")
    return {(f.parts[-4][8:18], f.parts[-3][11:] == "true", int(f.parts[-2][7:])) for f in found}


def test_a_load_writes_only_the_buckets_it_changes(spark):
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=16)
    names = [f"k{n}" for n in range(200)]
    bucket = {
        r.content_id: r.bucket for r in batch(spark, **dict.fromkeys(names, "h")).withColumn("bucket", core.bucket()).collect()
    }
    core.load(batch(spark, **dict.fromkeys(names, "h")), "2026-01-01", T1)
    assert files(core) == {("2026-01-01", True, n) for n in set(bucket.values())} and len(files(core)) == 16
    # one key changes, one is new, the others come again as they were
    touched = {bucket["k0"]}
    counts = core.load(batch(spark, **{**dict.fromkeys(names, "h"), "k0": "h2"}), "2026-01-02", T2)
    assert counts == {"current": 200, "opened": 1, "closed": 1}
    assert files(core) - {f for f in files(core) if f[0] == "2026-01-01"} == {
        ("2026-01-02", current, n) for n in touched for current in (True, False)
    }
    # nothing changes: nothing is written, and the load is there
    assert core.load(batch(spark, k0="h2", k1="h"), "2026-01-03", T3) == {"current": 200, "opened": 0, "closed": 0}
    assert not [f for f in files(core) if f[0] == "2026-01-03"] and core.snapshots()[-1] == "2026-01-03"
    assert core.state().count() == 201 and S.broken_versions(core.state()).count() == 0
    assert core.current().count() == 200
    # buckets that a kept load refers to outlive the load that wrote them
    assert core.expire_slices(keep=1) == ["2026-01-01", "2026-01-02"]
    assert ("2026-01-01", True, bucket["k0"]) not in files(core) and len(files(core)) == 17
    assert core.state().count() == 201
    with pytest.raises(ValueError):
        core.load(batch(spark, k0="h3"), "2026-01-02", T2, replay=lambda day: (batch(spark, k0="h2"), T3))


def test_new_keys_in_buckets_without_rows(spark):
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=64)
    core.load(batch(spark, a="h"), "2026-01-01", T1)
    assert core.load(batch(spark, **{f"k{n}": "h" for n in range(30)}), "2026-01-02", T2) == {"current": 31, "opened": 30, "closed": 0}
    core.load(batch(spark, k3="h2"), "2026-01-03", T3)
    assert core.state().count() == 32 and core.current().count() == 31
    assert S.broken_versions(core.state()).count() == 0


def test_first_load_without_rows(spark):
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=4)
    assert core.load(batch(spark), "2026-01-01", T1) == {"current": 0, "opened": 0, "closed": 0}
    assert core.state().count() == 0
    assert core.load(batch(spark, a="h"), "2026-01-02", T2) == {"current": 1, "opened": 1, "closed": 0}
    assert history(core.state()) == [("a", 1, "h", 2, True, True)]


def test_a_first_load_deals_its_rows_into_buckets_by_size_and_holds_no_batch(spark, monkeypatch):
    def held(*_, **__):
        raise AssertionError("a batch was held in memory")

    monkeypatch.setattr(type(spark.range(1)), "persist", held)
    monkeypatch.setattr(tables, "BUCKET_BYTES", 2000)
    core = CoreTable(spark, scratch_path(spark, "core"), buckets=2)
    names = [f"k{n}" for n in range(200)]
    core.load(batch(spark, **dict.fromkeys(names, "h")), "2026-01-01", T1)
    dealt = core.manifest.read()[1]["2026-01-01"]["buckets"]
    assert dealt >= 4 and {n for _, _, n in files(core)} == set(range(dealt))
    # later loads, also through a table object with the number as given, follow what the first one chose
    again = CoreTable(spark, core.path, buckets=2)
    stored = spark.read.parquet(written(spark, batch(spark, k0="h2", k1="h", new="h")))
    assert again.load(stored, "2026-01-02", T2, latest_by="updated_at", stored=True) == {"current": 201, "opened": 2, "closed": 1}
    assert {(d, n) for d, _, n in files(core) if d == "2026-01-02"} <= {("2026-01-02", n) for n in range(dealt)}
    assert again.current().count() == 201 and S.broken_versions(again.state()).count() == 0


def written(spark, df):
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    return path


def test_lists_left_out_of_moved_rows_come_back(spark):
    kinds = [("a,b", ["a", "b"]), ("a,b", ["a"]), ("", []), ("", [""]), (None, ["x"]), ("x", None), (None, None), ("a, b", ["a", "b"]), ("a,b", ["a,b"]),
             ("a", [None]), ("a,,", ["a", "", ""])]
    rows = spark.createDataFrame([(n, *kind) for n, kind in enumerate(kinds)], "n int, keywords string, keyword_list array<string>")
    moved = tables.without_lists(rows)
    assert {r.n for r in moved.collect() if r.keyword_list is None} == {0, 3, 5, 6, 10}
    assert sorted(tables.with_lists(moved).collect()) == sorted(rows.collect())
