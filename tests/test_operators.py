import random

import pytest

from cyclerlake.operators import joins
from cyclerlake.operators.chunks import Layout, Measured, collapse_copies, expand_copies, measure
from cyclerlake.operators.features import add_step_features
from cyclerlake.operators.joins import join_aux, join_aux_with_steps
from cyclerlake.operators.reports import summarise_steps, summarise_tests
from cyclerlake.operators.unions import select_union, union_all_columns

FINE = Layout(chunk_records=4)
HOT = Layout(chunk_records=4, hot_rows=3)


def numbered(rows):
    """Step counters of (test, seq, channel, time, second) rows in plain Python."""
    out = []
    for test in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == test), key=lambda r: (r[1], r[2] or 0))
        count, counted = 0, []
        for row in mine:
            count += row[3] == 0
            counted.append((row, count))
        for row, number in counted:
            low = min(r[1] for r, n in counted if n == number)
            start = min(r[4] for r in mine)
            out.append((*row, number, row[1] - low + 1, row[4] - start))
    return sorted(out, key=str)


def result(df):
    names = ["test", "seq_id", "auxchl_id", "test_time", "unix_time", "step_count", "step_index", "test_totaltime"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def series(seed, channels=(1,), copies=1):
    rng = random.Random(seed)
    rows = []
    for test in range(3):
        seq = rng.randint(-5, 5)
        for _ in range(rng.randint(1, 40)):
            seq += rng.randint(1, 3)
            time = rng.choice([0, 0, 1, 5])
            for channel in channels:
                rows += [(test, seq, channel, time, 1000 + seq * 7)] * rng.choice([1, copies])
    rng.shuffle(rows)
    return rows


SCHEMA = "test int, seq_id long, auxchl_id long, test_time long, unix_time long"


@pytest.mark.parametrize("layout", [Layout(), FINE, HOT, Layout(chunk_records=4, hot_rows=0)])
@pytest.mark.parametrize(("seed", "channels", "copies"), [(1, (1,), 1), (2, (1, 2), 1), (3, (1, 2, 3), 4)])
def test_against_plain_python(spark, layout, seed, channels, copies):
    rows = series(seed, channels, copies)
    got = result(add_step_features(spark.createDataFrame(rows, SCHEMA), ["test"], layout))
    assert got == numbered(rows)


def test_many_copies_of_a_step_start(spark):
    rows = [(0, 1, 1, 0, 5)] * 500 + [(0, 2, 1, 3, 6)]
    got = result(add_step_features(spark.createDataFrame(rows, SCHEMA), ["test"], HOT))
    assert got == numbered(rows)


def test_heavy_id_is_split_by_channel_and_content(spark):
    rng = random.Random(5)
    rows = [(0, 1, rng.randint(1, 400), 0, 5) for _ in range(900)]
    rows += [(0, 1, 7, 0, 5)] * 300 + [(0, 1, None, 0, 5)] * 40 + [(0, 2, 1, 3, 6), (0, 9, 1, 0, 8)]
    got = result(add_step_features(spark.createDataFrame(rows, SCHEMA), ["test"], Layout(4, 20)))
    assert got == numbered(rows)


def test_partitions_grow_with_the_data(spark):
    rows = series(8, (1, 2))
    many = Layout(chunk_records=4, task_rows=10)
    df = add_step_features(spark.createDataFrame(rows, SCHEMA), ["test"], many)
    assert result(df) == numbered(rows)
    assert f"_chunk" in plan_of(df) and f", {-(-len(rows) // 10)})" in plan_of(df)


def test_ties_count_by_row_not_by_peer(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "seq_id long, test_time long")
    assert sorted(r.step_count for r in add_step_features(df).collect()) == [1, 2, 2]


def test_records_before_the_first_start(spark):
    df = spark.createDataFrame([(5, 7), (6, 0), (7, None)], "seq_id long, test_time long")
    got = add_step_features(df).orderBy("seq_id").collect()
    assert [(r.step_count, r.step_index) for r in got] == [(0, 1), (1, 1), (1, 2)]


def test_null_test_and_null_id_are_kept(spark):
    rows = [(None, 1, 0), (None, 2, 1), (1, None, 0), (1, 3, 1), (1, 4, 0)]
    df = spark.createDataFrame(rows, "test int, seq_id long, test_time long")
    for layout in (FINE, Layout(chunk_records=4, hot_rows=0)):
        got = {(r.test, r.seq_id): (r.step_count, r.step_index) for r in add_step_features(df, ["test"], layout).collect()}
        assert got == {
            (None, 1): (1, 1),
            (None, 2): (1, 2),
            (1, None): (1, None),
            (1, 3): (1, 1),
            (1, 4): (2, 1),
        }


def test_missing_inputs_skip_features(spark):
    df = spark.createDataFrame([(1, 10), (2, 12)], "seq_id long, unix_time long")
    got = add_step_features(df)
    assert got.columns == ["seq_id", "unix_time", "test_totaltime"]
    assert sorted(r.test_totaltime for r in got.collect()) == [0, 2]
    assert add_step_features(df.select("seq_id")).columns == ["seq_id"]
    with pytest.raises(ValueError, match="seq_id"):
        add_step_features(spark.createDataFrame([(1,)], "test_time long"))


def test_raw_step_index_is_replaced(spark):
    df = spark.createDataFrame([(10, 0, 99), (11, 1, 99)], "seq_id long, test_time long, step_index long")
    assert sorted(r.step_index for r in add_step_features(df).collect()) == [1, 2]


def fanout(spark):
    main = spark.createDataFrame(
        [(1, 0), (2, 1), (3, 0), (4, 1)], "seq_id long, test_time long"
    )
    aux = spark.createDataFrame(
        [(s, c, 20.0 + c) for s in (1, 2, 3, 4) for c in (1, 2)], "seq_id long, auxchl_id long, test_tmp double"
    )
    return main, aux


@pytest.mark.parametrize("layout", [Layout(), FINE, Layout(chunk_records=2, hot_rows=1)])
def test_fanout(spark, layout):
    main, aux = fanout(spark)
    rows = join_aux_with_steps(main, aux, [], layout).orderBy("seq_id", "auxchl_id").collect()
    assert [r.step_count for r in rows] == [1, 2, 2, 2, 3, 4, 4, 4]
    records = join_aux_with_steps(main, aux, [], layout, "record").orderBy("seq_id", "auxchl_id").collect()
    assert [r.step_count for r in records] == [1, 1, 1, 1, 2, 2, 2, 2]
    assert [r.step_index for r in records] == [1, 1, 2, 2, 1, 1, 2, 2]


@pytest.mark.parametrize("layout", [Layout(), HOT, Layout(chunk_records=4, hot_rows=0), Layout(4, 3, 5)])
def test_join_and_steps_against_plain_python(spark, layout):
    rng = random.Random(11)
    main = [r for r in series(4) for _ in range(rng.choice([1, 1, 3]))]
    aux = [(r[0], r[1], c, 1.5 * c) for r in set(main) for c in range(1, rng.choice([1, 2, 5]))]
    aux += aux[:7] * 3
    joined = []
    for test, seq, _, time, second in main:
        matches = [a[2] for a in aux if a[:2] == (test, seq)] or [None]
        joined += [(test, seq, channel, time, second) for channel in matches]
    left = spark.createDataFrame(
        [(t, s, x, u) for t, s, _, x, u in main], "test int, seq_id long, test_time long, unix_time long"
    )
    right = spark.createDataFrame(aux, "test int, seq_id long, auxchl_id long, test_tmp double")
    got = join_aux_with_steps(left, right, ["test"], layout)
    assert result(got) == numbered(joined)
    plain = join_aux(left, right, ["test"], layout).select("test", "seq_id", "auxchl_id", "test_time", "unix_time")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(joined, key=str)


@pytest.mark.parametrize("limit", [0, 5, 100])
def test_few_and_many_step_starts_count_alike(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_STARTS", limit)
    main, aux = fanout(spark)
    # a start without a channel, one of a null id and one that is there twice
    extra = spark.createDataFrame([(5, 0), (None, 0), (7, 0), (7, 0)], "seq_id long, test_time long")
    channels = spark.createDataFrame([(7, 1, 21.0), (7, 2, 22.0), (None, 1, 5.0)], "seq_id long, auxchl_id long, test_tmp double")
    got = join_aux_with_steps(main.unionByName(extra), aux.unionByName(channels), [], FINE)
    rows = got.where("seq_id IS NOT NULL").orderBy("seq_id", "step_count").collect()
    # the null id comes first
    assert [r.step_count for r in rows] == [2, 3, 3, 3, 4, 5, 5, 5, 6, 7, 8, 9, 10]
    assert [r.step_count for r in got.where("seq_id IS NULL").collect()] == [1]


def test_channels_beside_step_starts_are_not_shuffled(spark, monkeypatch):
    main = spark.range(1000).selectExpr("id AS seq_id", "id % 500 AS test_time")
    aux = spark.range(1000).selectExpr("id AS seq_id", "explode(array(1L, 2L)) AS auxchl_id")
    seen = []
    lay_out = Measured.lay_out

    def counted(measured, df, place):
        if df.columns == ["seq_id", "_chunk"]:
            seen.append(df.count())
        return lay_out(measured, df, place)

    monkeypatch.setattr(Measured, "lay_out", counted)
    join_aux_with_steps(main, aux, [])
    assert seen == [2, 4]
    monkeypatch.setattr(joins, "BROADCAST_STARTS", 0)
    join_aux_with_steps(main, aux, [])
    assert seen == [2, 4, 2, 2000]


def test_clashing_names_get_a_suffix(spark):
    main = spark.createDataFrame([(1, 5.0)], "seq_id long, test_tmp double")
    aux = spark.createDataFrame([(1, 2, 7.0)], "seq_id long, auxchl_id long, test_tmp double")
    got = join_aux(main, aux).first().asDict()
    assert got == {"seq_id": 1, "test_tmp": 5.0, "auxchl_id": 2, "test_tmp_right": 7.0}


def test_null_keys_never_match(spark):
    main = spark.createDataFrame([(None, 1)], "seq_id long, v int")
    aux = spark.createDataFrame([(None, 2)], "seq_id long, auxchl_id long")
    for layout in (Layout(), Layout(hot_rows=0)):
        assert [r.auxchl_id for r in join_aux(main, aux, layout=layout).collect()] == [None]


def test_copies_round_trip(spark):
    df = spark.range(5).selectExpr("id AS seq_id", "'x' AS v")
    df = df.unionByName(df).unionByName(df.limit(1))
    assert collapse_copies(df).count() == 5
    assert sorted(expand_copies(collapse_copies(df)).collect()) == sorted(df.collect())


def test_union_common_columns_sorted(spark):
    a = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    b = spark.createDataFrame([(4, 5)], "a int, c int")
    got = select_union(a, b)
    assert got.columns == ["a", "c"]
    assert sorted(map(tuple, got.collect())) == [(2, 1), (4, 5)]
    assert select_union(a).columns == ["c", "a", "b"]
    assert select_union(a, a).count() == 2


def test_union_filters(spark):
    a = spark.createDataFrame([(1,), (2,)], "v int")
    assert select_union(a, a, wheres={"v": 1}).count() == 2
    assert select_union(a, a, wheres=[{"v": 1}, None]).count() == 3
    with pytest.raises(ValueError, match="filters"):
        select_union(a, a, wheres=[None])


def test_union_widens(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(2**40, 0.5, "x")], "a long, b double, c string")
    got = union_all_columns([a, b])
    assert got.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert sorted(map(tuple, got.collect())) == [(1, 2.0, None), (2**40, 0.5, "x")]
    text = spark.createDataFrame([("k",)], "a string")
    mixed = union_all_columns([a.select("a"), text])
    assert sorted(r.a for r in mixed.collect()) == ["1", "k"]


def test_reports(spark):
    rows = [(0, 1, 1, 3.0, 1), (0, 2, 1, 5.0, 2), (0, 3, 2, 4.0, 9)]
    df = spark.createDataFrame(rows, "test int, seq_id long, step_count long, test_vol double, test_capchg long")
    steps = summarise_steps(df, ["test"]).orderBy("step_count").collect()
    assert [(r.records, r.first_seq_id, r.last_seq_id) for r in steps] == [(2, 1, 2), (1, 3, 3)]
    assert [(r.test_vol_min, r.test_vol_max, r.test_vol_avg, r.test_capchg) for r in steps] == [
        (3.0, 5.0, 4.0, 2),
        (4.0, 4.0, 4.0, 9),
    ]
    summary = summarise_tests(df, ["test"]).first()
    assert (summary.records, summary.min_seq_id, summary.max_seq_id) == (3, 1, 3)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conversion_never_shuffles_and_prunes(spark):
    from cyclerlake.functions.conversions import transform_main

    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_id AS seq_id", "user_id AS test_time", "event_id AS test_vol", "value AS unused"
    )
    plan = plan_of(transform_main(raw, "0800", 260001).select("seq_id", "test_vol"))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_rows_are_shuffled_once(spark):
    from cyclerlake.session import tune

    tune(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
            "event_id AS seq_id", "user_id AS test", "event_id % 7 AS test_time", "props AS wide"
        )
        aux = rows.selectExpr("seq_id", "test", "1L AS auxchl_id", "2.0D AS test_tmp")
        df = join_aux_with_steps(rows, aux, ["test"], FINE)
        carrying = [line for line in plan_of(df).split("\n") if "Exchange hashpartitioning(test" in line]
        df.collect()
        initial = df._jdf.queryExecution().executedPlan().initialPlan().toString().split("\n")
        # below the window: main, aux, chunk starts; no exchange between join, union and window
        top = [i for i, line in enumerate(initial) if "Window [sum(" in line][0]
        union = next(i for i in range(top, len(initial)) if "Union" in initial[i])
        assert not any("Exchange" in line for line in initial[top:union])
        join = next(i for i in range(union, len(initial)) if "SortMergeJoin" in initial[i])
        assert not any("Exchange" in line for line in initial[union:join])
        assert carrying
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tied(seed):
    """Different rows of one id: channels, starts and values in any order."""
    rng = random.Random(seed)
    return [(rng.randint(0, 1), rng.choice([None, 1, 1, 2]), rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 0, 4]), rng.randint(0, 40)) for _ in range(120)]


def low(value):
    return (value is not None, value or 0)


@pytest.mark.parametrize("seed", range(4))
def test_ties_are_counted_in_one_order_at_every_size(spark, seed):
    rng = random.Random(seed)
    rows = tied(seed)
    want = []
    for test in (0, 1):
        count = 0
        for row in sorted((r for r in rows if r[0] == test), key=lambda r: tuple(map(low, r))):
            count += row[3] == 0
            want.append((*row, count))
    frame = spark.createDataFrame(rows, "test int, seq_id long, auxchl_id long, test_time long, test_vol long")
    layouts = [Layout(), Layout(rng.randint(1, 5), rng.randint(0, 30)), Layout(1, rng.randint(0, 5), rng.randint(3, 50), rng.randint(1, 2))]
    for layout in layouts:
        got = add_step_features(frame, ["test"], layout).select("test", "seq_id", "auxchl_id", "test_time", "test_vol", "step_count")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_starts_grow_with_chunks_not_records(spark, monkeypatch):
    from cyclerlake.operators import features

    rows = spark.range(4000).selectExpr("id div 64 AS seq_id", "id % 64 AS auxchl_id", "id % 7 AS test_time")
    counted, landed = {}, features.landed

    def counting(df, purpose):
        out = landed(df, purpose)
        counted[purpose] = out.count()
        return out

    monkeypatch.setattr(features, "landed", counting)
    add_step_features(rows, [], Layout(chunk_records=10, hot_rows=100)).collect()
    chunks, parts = -(-63 // 10), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert counted["chunk-starts"] <= chunks + parts


def test_first_and_last_of_tied_records(spark):
    rows = [(0, 1, 1, None, 0.7, 1), (0, 1, 1, 2, 0.5, 2), (0, 1, 1, 2, 0.9, None), (0, None, 1, 9, 0.1, None)]
    schema = "test int, seq_id long, step_count long, auxchl_id long, test_time double, test_capchg long"
    for order in (rows, rows[::-1]):
        got = summarise_steps(spark.createDataFrame(order, schema), ["test"]).first()
        assert (got.test_time_first, got.test_time_last, got.test_capchg) == (0.1, 0.9, 2)


@pytest.mark.parametrize("same", [True, False])
def test_product_of_copies_and_channels_is_spread(spark, same):
    layout = Layout(hot_rows=5000, task_rows=2000)
    text = "SELECT 1 AS test, 7L AS seq_id, CAST(id % 2 AS bigint) AS test_time, id AS vol FROM range(300)"
    main = spark.sql(text.replace("id AS vol", "0L AS vol") if same else text)
    aux = spark.sql("SELECT 1 AS test, 7L AS seq_id, id AS auxchl_id FROM range(200)")
    joined = join_aux(main, aux, ["test"], layout).selectExpr("*", "spark_partition_id() AS task")
    assert joined.select("vol", "test_time", "auxchl_id").distinct().count() == (400 if same else 60_000)
    per_task = [r["count"] for r in joined.groupBy("task").count().collect()]
    assert sum(per_task) == 60_000 and max(per_task) < 30_000
    for scope in ("row", "record"):
        counted = join_aux_with_steps(main, aux, ["test"], layout, scope, False).agg({"step_count": "max", "*": "count"}).first()
        assert sorted(counted) == sorted([60_000, 30_000 if scope == "row" else 150])


def test_ordinary_joins_are_not_hot(spark, monkeypatch):
    from cyclerlake.operators import joins

    seen = []
    keep = joins.measure
    monkeypatch.setattr(joins, "measure", lambda *given: seen.append(keep(*given)) or seen[-1])
    main = spark.range(200_000).selectExpr("1 AS test", "id AS seq_id")
    aux = spark.range(400_000).selectExpr("1 AS test", "id div 2 AS seq_id", "id % 2 AS auxchl_id")
    join_aux(main, aux, ["test"])
    assert seen[0].hot is None


@pytest.mark.parametrize(("most", "hot_rows"), [(100, 10), (3, 10), (3, 2), (3, 10_000), (1, 2)])
def test_firsts_of_groups_by_each_route(spark, monkeypatch, most, hot_rows):
    import cyclerlake.operators.features as features

    monkeypatch.setattr(features, "BROADCAST_GROUPS", most)
    # one test holds most records; nulls among keys and values, repeated rows
    rows = [(1, s, s // 4, 100 + s) for s in range(40)] + [(None, s, None, None if s % 2 else 7 - s) for s in range(8)]
    rows += [(2, 5, 0, 9), (2, 5, 0, 9), (3, None, 1, None)]
    df = spark.createDataFrame(rows, "test int, seq_id long, step_count int, unix_time long")
    got = add_step_features(df, ["test"], Layout(hot_rows=hot_rows)).collect()

    def lowest(column, *keys):
        held = {}
        for row in rows:
            if row[column] is not None:
                key = tuple(row[k] for k in keys)
                held[key] = min(held.get(key, row[column]), row[column])
        return held

    first, start = lowest(1, 0, 2), lowest(3, 0)
    want = [
        (t, s, c, u, None if s is None else s - first[t, c] + 1, None if u is None else u - start[t,])
        for t, s, c, u in rows
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert got[0].__fields__ == ["test", "seq_id", "step_count", "unix_time", "step_index", "test_totaltime"]


def test_few_groups_move_no_records(spark):
    df = spark.range(100).selectExpr("id % 3 AS test", "id AS seq_id", "id DIV 9 AS step_count")
    plan = add_step_features(df, ["test"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_small_tasks_are_not_more_than_rows_pay_for(spark):
    counts = spark.sql("SELECT 1 AS test, id AS _chunk, 4000L AS _rows, 4000L AS _joined FROM range(1000)")
    found = measure(counts, ["test"], Layout(chunk_records=10, hot_rows=60, task_rows=50))
    assert found.partitions == found.hot_parts == 200
    assert measure(counts, ["test"], Layout(task_rows=100_000)).partitions == 40


def test_many_chunks_are_numbered_from_one_join_of_their_starts(spark, monkeypatch):
    purposes, keep = [], joins.landed
    monkeypatch.setattr(joins, "landed", lambda df, purpose: purposes.append(purpose) or keep(df, purpose))
    main = series(21)
    aux = [(r[0], r[1], c) for r in main for c in (1, 2)]
    left = spark.createDataFrame([(t, s, x, u) for t, s, _, x, u in main], "test int, seq_id long, test_time long, unix_time long")
    right = spark.createDataFrame(aux, "test int, seq_id long, auxchl_id long")
    for blocks in (2, 4096):
        got = join_aux_with_steps(left, right, ["test"], Layout(chunk_records=4, block_chunks=blocks))
        assert result(got) == numbered([(t, s, c, x, u) for t, s, _, x, u in main for c in (1, 2)])
    assert purposes.count("chunk-zeros") == 1
