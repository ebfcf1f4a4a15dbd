"""Operators on small made inputs, against plain Python or the unsplit form of the same operator."""

import collections
import datetime
import math
import random
import statistics

import pytest

from pyspark.sql import Window, functions as F

from orderflow.functions import routes, scalars
from orderflow.operators import geo, graph, latency, loadtest, normalize, ordered, quantiles, relational, rollup, state
from orderflow.plans import dispatch, history
from orderflow.session import cut_lineage, materialize
from orderflow.sources import lake, stores

EVENT = (
    "event_type string, order_id long, status string, courier_id long, courier_available boolean, "
    "event_ts timestamp, arrival_ts timestamp, seq long"
)


def _events(spark, rows):
    """rows: (type, order, status, courier, available, arrival seconds)"""
    data = [(t, o, s, c, a, float(at), n) for n, (t, o, s, c, a, at) in enumerate(rows)]
    raw = spark.createDataFrame(
        data, "event_type string, order_id long, status string, courier_id long, courier_available boolean, at double, seq long"
    )
    at = F.timestamp_micros((F.col("at") * 1_000_000).cast("long"))
    return raw.select("*", at.alias("event_ts"), at.alias("arrival_ts")).drop("at")


def _random_events(spark, n=400, seed=5):
    r = random.Random(seed)
    kinds = ["ORDER_CREATED", "STATUS_CHANGE", "COURIER_ASSIGNED", "COURIER_AVAILABILITY", "COURIER_LOCATION", "UNKNOWN"]
    statuses = ["PREPARING", "READY_FOR_PICKUP", "IN_TRANSIT", "DELIVERED", "CANCELLED", None]
    rows, at = [], 0
    for _ in range(n):
        at += r.choice([0, 1, 5, 40, 90])
        # one order and one courier take a third of everything
        order = 1 if r.random() < 0.34 else r.randrange(2, 12)
        courier = 1 if r.random() < 0.34 else r.randrange(2, 9)
        kind = r.choice(kinds)
        status = r.choice(statuses) if kind in ("ORDER_CREATED", "STATUS_CHANGE") else None
        free = r.choice([True, False, None]) if kind == "COURIER_AVAILABILITY" else None
        rows.append((kind, order if r.random() < 0.95 else None, status, courier if r.random() < 0.9 else None, free, at))
    return _events(spark, rows), rows


def _fold(rows):
    """The live state after all rows, one row at a time."""
    status, held, holder, free, seen = {}, set(), {}, {}, set()
    for kind, order, new, courier, available, _at in rows:
        if kind == "ORDER_CREATED" and order is not None:
            seen.add(order)
            status[order] = new or "PENDING"
        elif kind == "STATUS_CHANGE" and order is not None and new:
            seen.add(order)
            status[order] = new
            if new == "DELIVERED" and order in holder:
                free[holder[order]] = True
        elif kind == "COURIER_AVAILABILITY" and courier is not None and available is not None:
            free[courier] = available
        elif kind == "COURIER_LOCATION" and courier is not None and order is not None:
            free[courier] = False
        elif kind == "COURIER_ASSIGNED" and order is not None:
            seen.add(order)
            held.add(order)
            if courier is not None:
                holder[order] = courier
                free[courier] = False
    return status, held, free, seen


def _bag(df):
    return sorted(map(str, df.collect()))


def test_carry_is_the_same_on_split_keys(spark):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 2, None]), r.randrange(500), i, r.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, t long, id long, v long")
    wanted = dict(previous={"p": F.col("v")}, last_known={"l": F.col("v")}, running_sum={"s": F.col("v")})
    plain = ordered.carry(df, ["k"], ["t", "id"], **wanted)
    split = ordered.mark(df, F.floor(F.col("t") / 10))
    assert ordered.SLICE in split.columns
    assert _bag(ordered.carry(split, ["k"], ["t", "id"], **wanted).select(plain.columns)) == _bag(plain)
    # without keys everything is sliced
    whole = ordered.carry(ordered.mark(df, F.floor(F.col("t") / 10)), [], ["t", "id"], **wanted).drop(ordered.SLICE)
    one = ordered.carry(df.withColumn("c", F.lit(1)), ["c"], ["t", "id"], **wanted).drop("c")
    assert _bag(whole) == _bag(one)


def test_value_slices_grow_with_the_value(spark):
    values = sorted([0.0, 1e-12, 0.001, 0.0099999, 0.01, 9.99, 9.999999999999998, 10.0, 99.9, 100.0, 999.9999999999999, 1000.0, 1e9, -0.5, -7.0, -1000.0])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered.value_slice(F.col("v")).alias("s"))
    slices = [r.s for r in sorted(df.collect())]
    assert slices == sorted(slices)


def test_state_equals_a_row_by_row_fold(spark):
    events, rows = _random_events(spark)
    status, held, free, seen = _fold(rows)
    got = {r.order_id: (r.status, r.has_courier) for r in state.latest_orders(events).collect()}
    assert got == {o: (status.get(o), o in held) for o in seen}
    newest = state.courier_signals(events).groupBy("courier_id").agg(F.max_by("available", state.position()).alias("a"))
    assert {r.courier_id: r.a for r in newest.collect()} == free
    snap = state.realtime_snapshot(events).first()
    assert snap.total_orders_processed == len(seen) and snap.tracked_orders == len(status)
    assert snap.orders_delivered == sum(s == "DELIVERED" for s in status.values())
    assert snap.orders_waiting_courier == sum(s == "READY_FOR_PICKUP" and o not in held for o, s in status.items())
    last = rows[-1][5]
    assert snap.orders_processed_per_minute == sum(r[5] >= last - 60 for r in rows)


def test_late_creation_resets_status_by_arrival_but_not_by_event_time(spark):
    events = _events(spark, [("STATUS_CHANGE", 1, "DELIVERED", None, None, 10), ("ORDER_CREATED", 1, None, None, None, 11)])
    early = F.when(F.col("seq") == 1, F.timestamp_seconds(F.lit(1))).otherwise(F.col("event_ts"))
    events = events.withColumn("event_ts", early)
    assert state.latest_orders(events).first().status == "PENDING"
    assert state.latest_orders(events, time="event_ts").first().status == "DELIVERED"


def test_delivery_frees_only_an_earlier_assignment(spark):
    before = _events(spark, [("STATUS_CHANGE", 1, "DELIVERED", None, None, 1), ("COURIER_ASSIGNED", 1, None, 9, None, 2)])
    after = _events(spark, [("COURIER_ASSIGNED", 1, None, 9, None, 1), ("STATUS_CHANGE", 1, "DELIVERED", None, None, 2)])
    assert state.courier_state(before).first().available is False
    assert state.courier_state(after).first().available is True


def test_rollup_equals_repeated_snapshots(spark):
    events, rows = _random_events(spark, 200)
    width = 30
    changes = rollup.bucket_changes(events, width).cache()
    got = {r.bucket: r for r in rollup.ring(changes, rollup.newest_bucket(events, width), width, size=40).collect()}
    newest = max(r[5] for r in rows) // width * width
    assert sorted(got) == [newest - i * width for i in range(39, -1, -1)]
    prev = None
    for bucket in [newest - 40 * width, *sorted(got)]:
        upto = [r for r in rows if r[5] < bucket + width]
        status, held, free, seen = _fold(upto)
        delivered = sum(s == "DELIVERED" for s in status.values())
        if bucket in got:
            row = got[bucket]
            assert (row.orders_delivered, row.total_processed, row.couriers_available) == (delivered, len(seen), sum(free.values()))
            assert row.orders_waiting_courier == sum(s == "READY_FOR_PICKUP" and o not in held for o, s in status.items())
            assert (row.new_orders, row.new_delivered) == (len(seen) - prev[0], max(delivered - prev[1], 0))
            recent = [r for r in upto if r[5] >= bucket - 59 * width and r[0] == "ORDER_CREATED" and r[1] is not None]
            assert row.created_per_min == len(recent)
        prev = (len(seen), delivered)


def test_sliding_rate_bounds_are_inclusive(spark):
    events = _events(spark, [("UNKNOWN", None, None, None, None, t) for t in (0, 60, 61, 61, 200)])
    got = {r.at_us // 1_000_000: r.events for r in rollup.sliding_rate(events, 60).collect()}
    assert got == {0: 1, 60: 2, 61: 3, 200: 1}


def test_window_summary_counts_both_bounds(spark):
    events = _events(spark, [("A", None, None, None, None, t) for t in (60, 90, 120)])
    got = {r.window_end: r.window_events for r in rollup.window_summary(events).collect()}
    assert got == {60: 1, 120: 3, 180: 1}


@pytest.mark.parametrize("crowd", [quantiles.SLICE_VALUES, 3])
def test_percentiles(spark, monkeypatch, crowd):
    monkeypatch.setattr(quantiles, "SLICE_VALUES", crowd)
    r = random.Random(3)
    data = {None: [4.0, 8.0], "a": [round(r.expovariate(0.01), 2) for _ in range(257)], "b": [5.0], "c": [1.0, 1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    wanted = {"p50": quantiles.linear("v", 0.5), "p95": quantiles.linear("v", 0.95), "x95": quantiles.exclusive("v", 95)}
    for row in quantiles.percentiles(df, ["g"], "v", wanted).collect():
        values = sorted(data[row.g])

        def at(p):
            rank = (len(values) - 1) * p
            low = int(rank)
            return values[low] * (1 - (rank - low)) + values[min(low + 1, len(values) - 1)] * (rank - low)

        assert math.isclose(row.p50, at(0.5)) and math.isclose(row.p95, at(0.95))
        exclusive = values[0] if len(values) == 1 else statistics.quantiles(values, n=100)[94]
        assert math.isclose(row.x95, exclusive)


def test_values_with_the_same_digits_are_many_slices(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SLICE_VALUES", 10)
    values = [1_700_000_000 + i * 0.25 for i in range(4000)] + [-3.0 - i / 1e6 for i in range(500)] + [i * 1e-12 for i in range(300)] + [7.0]
    df = spark.createDataFrame([("g", v) for v in values] + [(None, v) for v in values[:2000]], "g string, v double")
    rows = quantiles.sliced(df, ["g"], "v").collect()
    assert len(rows) == len(values) + 2000
    for group in ("g", None):
        mine = sorted((x for x in rows if x.g == group), key=lambda x: x.v)
        assert [x[ordered.SLICE] for x in mine] == sorted(x[ordered.SLICE] for x in mine)
        sizes = collections.Counter(x[ordered.SLICE] for x in mine)
        assert max(sizes.values()) <= 12 and len(sizes) >= len(mine) / 12


def test_sliding_rate_equals_a_scan(spark):
    r = random.Random(12)
    times = [r.choice([r.randint(0, 4000), r.randint(900, 960), 3600 * r.randint(0, 2)]) for _ in range(300)]
    events = _events(spark, [(r.choice(["ORDER_CREATED", "UNKNOWN"]), i if i % 3 else None, None, None, None, t) for i, t in enumerate(times)])
    rows = [(x.arrival_ts.timestamp(), x.event_type == "ORDER_CREATED" and x.order_id is not None) for x in events.collect()]
    zero = min(t for t, _ in rows)
    for width in (1, 60, 61, 3600):
        got = {x.at_us / 1e6: (x.events, x.created) for x in rollup.sliding_rate(events, width).collect()}
        first = min(got) - zero
        assert got == {t + first: (sum(t - width <= u <= t for u, _ in rows), sum(t - width <= u <= t and c for u, c in rows)) for t, _ in rows}


def test_nearest_equals_brute_force(spark):
    r = random.Random(7)
    crowd = [(i, 5 + r.random() * 1e-5, 5 + r.random() * 1e-5) for i in range(400)]
    wide = [(1000 + i, r.random() * 10, r.random() * 10) for i in range(100)]
    same = [(2000 + i, 1.0, 1.0) for i in range(200)]
    nodes = crowd + wide + same
    points = [(r.random() * 12 - 1, r.random() * 12 - 1) for _ in range(60)] + [(5.0, 5.0), (1.0, 1.0), (-50.0, 3.0)]
    found = geo.nearest(spark.createDataFrame(points, "x double, y double"), spark.createDataFrame(nodes, "id long, x double, y double"))
    got = {(p.x, p.y): p.id for p in found.collect()}
    assert got == {(x, y): min(((nx - x) ** 2 + (ny - y) ** 2, i) for i, nx, ny in nodes)[1] for x, y in points}


def test_geofence_and_its_fallback(spark):
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "restaurant_id long, lat double, lon double")
    edge = math.sqrt(0.05)
    couriers = spark.createDataFrame(
        [(1, 0.1, 0.1), (2, edge + 1e-9, 0.0), (3, -0.15, -0.15), (0, 0.0, 0.22)], "courier_id long, lat double, lon double"
    )
    rows = geo.geofence_candidates(places, couriers).collect()
    assert sorted((r.restaurant_id, r.courier_id) for r in rows if not r.anyone) == [(1, 0), (1, 1), (1, 3)]
    assert [(r.restaurant_id, r.courier_id) for r in rows if r.anyone] == [(2, None)]


def _dijkstra(edges, source):
    dist, todo = {source: 0.0}, {source}
    while todo:
        n = min(todo, key=dist.get)
        todo.remove(n)
        for u, v, w in edges:
            for a, b in ((u, v), (v, u)):
                if a == n and dist[n] + w < dist.get(b, math.inf):
                    dist[b] = dist[n] + w
                    todo.add(b)
    return dist


def _road_map(spark, seed=11):
    r = random.Random(seed)
    nodes = [(i, r.random(), r.random()) for i in range(30)]
    edges = [(i, r.randrange(i), float(r.randrange(1, 9))) for i in range(1, 28)] + [(3, 3, 1.0), (28, 29, 2.0)]
    return nodes, edges, spark.createDataFrame(nodes, "id long, x double, y double"), spark.createDataFrame(edges, "u long, v long, length double")


def test_shortest_distances(spark):
    _, edges, _, frame = _road_map(spark)
    roads = graph.collapse_edges(frame)
    sources = spark.createDataFrame([(0, 0), (9, 9), (28, 28)], "src long, node long")
    got = {}
    for r in graph.shortest_distances(roads, sources).collect():
        got.setdefault(r.src, {})[r.node] = r.dist
    assert got == {s: _dijkstra(edges, s) for s in (0, 9, 28)}
    near = graph.shortest_distances(roads, sources, cutoff=6).collect()
    assert {(r.src, r.node): r.dist for r in near} == {(s, n): d for s in got for n, d in got[s].items() if d <= 6}


def test_a_long_chain_needs_few_rounds(spark, monkeypatch):
    """2,000 roads in a row, a ring on the way, a ring that nothing leads to; lengths that no double holds exactly."""
    edges = [(i, i + 1, 0.1 * (i % 7)) for i in range(2000)]
    edges += [(1000, 5000, 0.3), (5000, 5001, 0.1), (5001, 1000, 0.2), (7000, 7001, 1.0), (7001, 7002, 1.0), (7002, 7000, 1.0)]
    frame = graph.collapse_edges(spark.createDataFrame(edges, "u long, v long, length double"))
    steps = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: steps.append(1) or cut_lineage(df))
    labels = cut_lineage(graph.shortest_distances(frame, spark.createDataFrame([(1, 3), (2, 1500)], "src long, node long")))
    assert len(steps) < 24
    got = {(r.src, r.node): r.dist for r in labels.collect()}
    want = {(s, n): d for s, start in ((1, 3), (2, 1500)) for n, d in _dijkstra(edges, start).items()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    targets = spark.createDataFrame([(1, 2000), (2, 5001), (2, 7000)], "src long, node long")
    path = [(r.src, r.target, r.node) for r in graph.walk_back(labels, targets).orderBy("src", "step").collect()]
    assert path == [(1, 2000, n) for n in range(2000, 2, -1)] + [(2, 5001, 5001)] + [(2, 5001, n) for n in range(1000, 1501)]


def test_slices_of_a_stretch_add_up(spark, monkeypatch):
    monkeypatch.setattr(graph, "SLICE_ROADS", 3)
    edges = [(i, i + 1, float(i % 5)) for i in range(40)]
    frame = graph.collapse_edges(spark.createDataFrame(edges, "u long, v long, length double"))
    labels = graph.shortest_distances(frame, spark.createDataFrame([(1, 11)], "src long, node long"))
    assert {r.node: r.dist for r in labels.collect()} == _dijkstra(edges, 11)


def test_nearest_source_takes_the_lowest_of_equals(spark):
    edges = [(1, 2, 2.0), (2, 3, 2.0), (3, 4, 5.0), (8, 9, 1.0)]
    roads = graph.contract(
        graph.collapse_edges(spark.createDataFrame(edges, "u long, v long, length double")), spark.range(1, 10).withColumnRenamed("id", "node")
    )
    sources = spark.createDataFrame([(7, 3), (5, 1), (6, 1)], "src long, node long")
    got = {r.node: (r.src, r.dist) for r in graph.nearest_source(roads, sources).collect()}
    assert got == {1: (5, 0.0), 2: (5, 2.0), 3: (7, 0.0), 4: (7, 5.0)}


def test_the_nearest_of_all_may_lie_outside_the_fence(spark):
    """Place 1: a courier out of reach is nearer by road than the one in reach. Place 2: nobody in reach, roads lead to both."""
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0), (3, 0.1, 0.1), (4, 9.0, 9.0)], "id long, x double, y double")
    roads = graph.collapse_edges(spark.createDataFrame([(1, 2, 1.0), (1, 3, 8.0), (2, 4, 3.0)], "u long, v long, length double"))
    couriers = spark.createDataFrame([(10, 5.0, 5.0), (11, 0.1, 0.1)], "courier_id long, lat double, lon double")
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 9.0)], "restaurant_id long, lat double, lon double")
    got = {r.restaurant_id: (r.courier_id, r.dist) for r in dispatch.match_couriers(places, couriers, nodes, roads).collect()}
    assert got == {1: (11, 8.0), 2: (10, 3.0)}


def test_parallel_edges_collapse(spark):
    frame = spark.createDataFrame([(1, 2, 5.0), (2, 1, 3.0), (1, 3, None)], "u long, v long, length double")
    assert sorted(map(tuple, graph.collapse_edges(frame).collect())) == [(1, 2, 3.0), (1, 3, 1.0)]


def test_match_and_routes(spark):
    nodes, edges, node_frame, edge_frame = _road_map(spark)
    roads = graph.collapse_edges(edge_frame)
    at = {i: (x, y) for i, x, y in nodes}
    couriers = [(0, 4), (1, 17), (2, 22), (3, 4)]
    places = [(100, 0), (101, 20), (102, 29)]
    cf = spark.createDataFrame([(c, at[n][1], at[n][0]) for c, n in couriers], "courier_id long, lat double, lon double")
    pf = spark.createDataFrame([(p, at[n][1], at[n][0]) for p, n in places], "restaurant_id long, lat double, lon double")
    got = {r.restaurant_id: (r.courier_id, r.dist) for r in dispatch.match_couriers(pf, cf, node_frame, roads).collect()}
    for place, node in places:
        dist = _dijkstra(edges, node)

        def near(c):
            return (at[c][0] - at[node][0]) ** 2 + (at[c][1] - at[node][1]) ** 2 < 0.05

        eligible = [c for c in couriers if near(c[1])] or couriers
        reached = [(dist[n], c) for c, n in eligible if n in dist]
        want = min(reached) if reached else (None, min(c for c, _ in eligible))
        assert got[place] == (want[1], want[0])

    trips = spark.createDataFrame([(1, 0, 20, 4), (2, 0, 0, 17)], "order_id long, restaurant_node long, client_node long, courier_node long")
    legs = {}
    for r in dispatch.route_legs(trips, node_frame, roads).orderBy("position").collect():
        legs.setdefault((r.order_id, r.leg), []).append(r.node)
    lengths = {}
    for u, v, w in edges:
        for key in ((u, v), (v, u)):
            lengths[key] = min(w, lengths.get(key, math.inf))
    from_restaurant = _dijkstra(edges, 0)
    for (order, leg), path in legs.items():
        start, end = {(1, "pickup"): (4, 0), (1, "delivery"): (0, 20), (2, "pickup"): (17, 0), (2, "delivery"): (0, 0)}[order, leg]
        assert (path[0], path[-1]) == (start, end)
        assert sum(lengths[a, b] for a, b in zip(path, path[1:])) == from_restaurant[start if end == 0 else end]
    assert len(legs) == 4


def test_route_expressions(spark):
    df = spark.range(1).select(routes.point(F.lit(0.0), F.lit(10.0)).alias("a"), routes.point(F.lit(1.0), F.lit(20.0)).alias("b"))
    a, b = F.col("a"), F.col("b")
    row = df.select(
        routes.straight(a, b).alias("s"),
        routes.densify(F.array(a, b, a)).alias("d"),
        routes.densify(F.array(a)).alias("none"),
        routes.every_second(F.array(a)).alias("one"),
        routes.join_legs(F.array(a, b), F.array(b, a)).alias("legs"),
        routes.track(a, b, 1, F.lit(5.0)).alias("t"),
    ).first()
    assert len(row.s) == 20 and row.s[0] == (0.0, 10.0) and row.s[19][0] < 1.0
    assert len(row.d) == 10 and row.d[5] == (1.0, 20.0) and row.none == [] and len(row.one) == 1
    assert [p.lat for p in row.legs] == [0.0, 1.0, 0.0]
    assert [(p.lat, p.at) for p in row.t] == [(0.0, 5.0), (1.0, 5.1)]


def test_history_orders_by_time_then_id_and_reads_bad_times_as_1970(spark):
    rows = [
        (1, 7, "A", None, None, "2024-01-15T10:00:00+00:00"),
        (2, 7, "B", None, None, "2024-01-15T10:00:00+00:00"),
        (3, 7, "C", None, None, "bad"),
        (4, 8, None, "D", None, None),
        (5, 9, None, None, None, None),
        (6, None, "Z", None, None, None),
    ]
    lake = spark.createDataFrame(rows, "event_id int, order_id int, event_status string, to_status string, from_status string, created_at string")
    lake = lake.select("*", F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("15").alias("day"), F.lit("10").alias("hour"))
    got = {r.order_id: r.status for r in history.latest_order_status(lake).collect()}
    assert got == {7: "B", 8: "D", 9: "UNKNOWN"}
    kpis = history.history_kpis(lake).first()
    assert (kpis.total_events, kpis.total_orders, kpis.orders_open) == (6, 3, 3)
    # passing over rows without a status
    only = history.latest_order_status(lake, F.coalesce("event_status", "to_status", "from_status"))
    assert {r.order_id: r.status for r in only.collect()} == {7: "B", 8: "D", 9: None}


def test_emit_latency_needs_a_recent_event(spark):
    rows = [(0, "p", 1000, 2000, 122_000, 1.0, 1.0, 1, 1), (1, "p", 1000, 2000, 122_001, 1.0, 1.0, 1, 1), (2, "p", 9000, 9000, 5000, 1.0, 1.0, 1, 1)]
    shown = spark.createDataFrame(
        rows, "seq long, pipeline string, produced_at_ms long, processed_at_ms long, emitted_at_ms long, latency_last_ms double, "
        "latency_avg_1m_ms double, events_per_minute long, total_orders long",
    )
    got = [r.event_to_dashboard_emit_latency_ms for r in latency.latency_samples(shown).orderBy("last_event_produced_at_ms", "recorded_at").collect()]
    assert got == [121_000.0, None, 0.0]


def test_run_outcomes(spark):
    schema = "run_id string, seq long, is_create boolean, status_code int, has_json boolean, order_id long, order_status string"
    rows = [
        ("a", 1, True, 500, True, 1, None),
        ("b", 1, True, 200, False, 1, None),
        ("c", 1, True, 200, True, None, None),
        ("d", 1, True, 200, True, 4, None), ("d", 2, False, 404, True, 4, None), ("d", 3, False, 500, True, 4, None),
        ("e", 1, True, 200, True, 5, None), ("e", 2, False, 0, True, 5, None),
        ("f", 1, True, 200, True, 6, None), ("f", 2, False, 200, True, 6, "PREPARING"),
        ("g", 1, True, 201, True, 7, None), ("g", 2, False, 200, True, 7, "PREPARING"), ("g", 3, False, 200, True, 7, "DELIVERED"),
        ("h", 1, True, 200, True, 8, None),
    ]
    got = {r.run_id: r.error for r in loadtest.order_outcomes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        "a": "failed_to_create_order",
        "b": "missing_order_response_json",
        "c": "missing_order_id",
        "d": "order_not_visible_after_creation",
        "e": "order_query_errors",
        "f": "order_not_delivered_last_status=PREPARING",
        "g": None,
        "h": "order_not_delivered_last_status=None",
    }


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", True)], "id long, v string, f boolean")
    new = spark.createDataFrame([(2, "x", False, 1), (2, None, None, 2), (3, "y", True, 1), (3, "z", True, 2)], "id long, v string, f boolean, n long")
    assert sorted(map(tuple, relational.upsert(old, new, "id", "n").collect())) == [(1, "a", True), (2, None, None), (3, "z", True)]
    assert sorted(map(tuple, relational.insert_if_absent(old, new, "id", "n").collect())) == [(1, "a", True), (2, "b", True), (3, "y", True)]


def test_snapshots_expire(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", 100, "1"), ("a", 200, "2"), ("b", 80, "3")], "name string, t long, payload string")
    stores.write_snapshots(rows.select("name", F.timestamp_seconds("t").alias("stored_at"), "payload"), path)
    assert [(r.name, r.payload) for r in stores.read_snapshots(spark, path).collect()] == [("a", "2")]
    early = stores.read_snapshots(spark, path, as_of=F.timestamp_seconds(F.lit(150)))
    assert {r.name for r in early.collect()} == {"a", "b"}


def test_status_predicates_and_snapshot_age(spark):
    df = spark.createDataFrame([(" delivered ",), ("PENDING",), ("REJECTED",), ("CONFIRMED",), (None,)], "s string")
    assert [r[0] for r in df.select(normalize.is_valid_status(F.col("s"))).collect()] == [True, False, False, True, None]
    ages = spark.createDataFrame([(1000, 5000), (9000, 5000), (0, 5000), (None, 5000)], "p long, now long")
    assert [r[0] for r in ages.select(latency.snapshot_age_ms(F.col("p"), F.col("now"))).collect()] == [4000, 0, None, None]


def test_one_key_with_a_third_of_all_rows_is_sliced(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t long")
    split = ordered.mark(df, F.floor(F.col("t") / 100))
    sizes = split.groupBy("k", ordered.SLICE).count().agg(F.max("count")).first()[0]
    assert sizes <= 100


def test_assignment_is_judged_request_by_request(spark):
    orders = [(1, None), (2, None), (3, 30), (4, None), (5, None)]
    couriers = [(10, True), (11, True), (12, False), (30, True), (13, True)]
    requests = [(1, 10), (1, 11), (2, 11), (2, 11), (9, 13), (3, 13), (3, 30), (4, 30), (4, 12), (4, 99), (5, 10), (4, 13), (5, 13), (4, 10)]
    of = dict(orders)
    free = {c for c, f in couriers if f}
    want = []
    for order, courier in requests:
        if order not in of:
            want.append("order_not_found")
        elif of[order] is not None and of[order] != courier:
            want.append("assigned_to_another" if dict(orders)[order] is not None else "order_taken_earlier")
        elif of[order] is None and courier not in free:
            want.append("courier_taken_earlier" if dict(couriers).get(courier) else "courier_unavailable")
        else:
            want.append("assigned" if of[order] is None else "already_assigned")
            of[order] = courier
            free.discard(courier)
    got = relational.assignment_conflicts(
        spark.createDataFrame([(*r, i) for i, r in enumerate(requests)], "order_id long, courier_id long, seq long"),
        spark.createDataFrame(orders, "order_id long, courier_id long"),
        spark.createDataFrame(couriers, "user_id long, is_available boolean"),
    )
    assert [r.outcome for r in sorted(got.collect(), key=lambda r: r.seq)] == want
    assert want[:3] == ["assigned", "order_taken_earlier", "assigned"]


@pytest.mark.parametrize("prefix", [1, 7, 10_000])
def test_greedy_replays_prefixes(spark, prefix):
    r = random.Random(prefix)
    requests = list({(r.randint(0, 25), r.randint(0, 25)) for _ in range(120)})
    r.shuffle(requests)
    requests = [(o, c, 3 * i) for i, (o, c) in enumerate(requests)]
    got = relational._greedy(spark.createDataFrame(requests, "order_id long, courier_id long, seq long"), prefix)
    orders, couriers, want = set(), set(), set()
    for o, c, i in requests:
        if o not in orders and c not in couriers:
            orders.add(o)
            couriers.add(c)
            want.add((o, c, i))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_a_long_chain_of_requests_ends_in_one_round(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(relational, "materialize", lambda df, name: seen.append(name) or materialize(df, name))
    chain = [((i + 1) // 2, i // 2, i) for i in range(10_000)]
    got = relational._greedy(spark.createDataFrame(chain, "order_id long, courier_id long, seq long"))
    assert sorted(x.seq for x in got.collect()) == list(range(0, 10_000, 2))
    assert seen.count("requests-taken") == 1


def test_roads_of_no_length_end_and_negative_ones_fail(spark):
    roads = graph.collapse_edges(spark.createDataFrame([(9, 2, 5.0), (2, 3, 0.0), (3, 4, 0.0), (4, 2, 0.0)], "u long, v long, length double"))
    labels = graph.shortest_distances(roads, spark.createDataFrame([(9, 9)], "src long, node long"))
    path = graph.walk_back(labels, spark.createDataFrame([(9, 4), (9, 7)], "src long, node long"))
    assert [(r.step, r.node, r.dist) for r in path.orderBy("step").collect()] == [(0, 4, 5.0), (1, 2, 5.0), (2, 9, 0.0)]
    with pytest.raises(Exception, match="negative length"):
        graph.collapse_edges(spark.createDataFrame([(1, 2, -1.0)], "u long, v long, length double")).collect()


def test_a_leg_without_roads_is_a_straight_line(spark):
    roads = graph.collapse_edges(spark.createDataFrame([(1, 2, 3.0), (8, 9, 1.0)], "u long, v long, length double"))
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (8, 5.0, 5.0), (9, 6.0, 6.0)], "id long, x double, y double")
    trips = spark.createDataFrame([(1, 2, 8, 1)], "order_id long, restaurant_node long, client_node long, courier_node long")
    rows = dispatch.route_legs(trips, nodes, roads).orderBy("leg", "position").collect()
    line = [(r.lat, r.node, r.dist) for r in rows if r.leg == "delivery"]
    assert len(line) == 20 and line[0] == (1.0, None, None) and line[5][0] == 2.0
    assert [(r.position, r.node) for r in rows if r.leg == "pickup"] == [(0, 1), (1, 2)]


def test_averages_keep_all_decimals(spark):
    values = spark.createDataFrame([(0.0004,), (0.0004,), (12.3456789,), (None,)], "v double")
    assert abs(values.agg(scalars.exact_avg(F.col("v"))).first()[0] - 12.3464789 / 3) < 1e-12
    assert spark.createDataFrame([(1e30,), (3e30,)], "v double").agg(scalars.exact_avg(F.col("v"))).first()[0] == 2e30


def test_geofence_counts_like_all_pairs(spark):
    """Crowded spots, couriers on the circle's edge, restaurants far away, ids of 0 and missing coordinates."""
    draw = random.Random(6)
    places = [(i, draw.uniform(-1, 1), draw.uniform(-1, 1)) for i in range(60)] + [(100, 50.0, 50.0), (101, None, 0.0), (102, 0.0, 0.0)]
    free = [(i, draw.gauss(0, 0.3), draw.gauss(0, 0.3)) for i in range(1500)] + [(2000 + i, 0.25, 0.25) for i in range(300)]
    free += [(3000, 0.0, math.sqrt(0.05)), (3001, math.sqrt(0.05), 0.0), (3002, None, 0.0), (3003, 0.0, None)]
    found = geo.geofence_counts(
        spark.createDataFrame(places, "restaurant_id long, lat double, lon double"),
        spark.createDataFrame(free, "courier_id long, lat double, lon double"), levels=3,
    )

    def reached(lat, lon):
        if lat is None or lon is None:
            return []
        known = [(i, a - lat, b - lon) for i, a, b in free if a is not None and b is not None]
        return [i for i, dy, dx in known if dy * dy + dx * dx < 0.05]

    want = {i: (len(r), min(r, default=None), not r) for i, lat, lon in places for r in [reached(lat, lon)]}
    assert {r.restaurant_id: (r.couriers, r.courier_id, r.anyone) for r in found.collect()} == want
    assert {r.anyone for r in found.collect()} == {True, False}


def test_ranges_of_days(spark, tmp_path):
    """Ranges inside a day, a month, a year and over years, as predicate and as folders; folders that are missing."""
    first = datetime.date(2023, 11, 20)
    every = [first + datetime.timedelta(days=i) for i in range(0, 420, 1)]
    rows = [(i, f"{d:%Y}", f"{d:%m}", f"{d:%d}", "07") for i, d in enumerate(every) if i % 9]
    table = spark.createDataFrame(rows, "event_id int, year string, month string, day string, hour string")
    lake.write_lake(table, str(tmp_path / "lake"))
    for low, high in (("2024-02-03", "2024-02-03"), ("2024-02-03", "2024-02-20"), ("2024-02-25", "2024-05-02"), ("2023-12-30", "2024-01-02"), ("2023-01-01", "2025-12-31"), ("2030-01-01", "2030-01-05")):
        want = {i for i, y, m, d, _ in rows if low <= f"{y}-{m}-{d}" <= high}
        assert {r.event_id for r in table.where(lake.days(low, high)).collect()} == want
        assert {r.event_id for r in lake.read_days(spark, str(tmp_path / "lake"), low, high).collect()} == want
    days = lake.read_days(spark, str(tmp_path / "lake"), "2024-02-25", "2024-03-02").inputFiles()
    assert len(days) <= 7 and all("year=2024/month=0" in f for f in days)
    plan = lake.read_lake(spark, str(tmp_path / "lake")).where(lake.days("2024-02-25", "2024-05-02"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_detail_of_one_order(spark, tmp_path):
    """The document of one order is that order's part of all documents, and the filter reaches every scan."""
    stamp = "timestamp '2024-01-01 00:00:00'"
    made = {
        "orders": spark.range(50).selectExpr("id as order_id", "id % 7 as client_id", "1L as restaurant_id", "2L as courier_id", "'PREPARING' as order_status", f"{stamp} as created_at"),
        "items": spark.range(90).selectExpr("id % 45 as order_id", "id as line", "concat('part ', id) as item_name", "3L as quantity"),
        "events": spark.range(120).selectExpr("id % 60 as order_id", "id as event_id", "'STATUS_CHANGE' as event_type", "'a' as from_status", "'b' as to_status",
            "'b' as event_status", "'m' as event_message", "1.0D as latitude", "1.0D as longitude", "'2024-01-01' as created_at"),
    }
    for name, df in made.items():
        df.write.parquet(str(tmp_path / name))
    tables = [spark.read.parquet(str(tmp_path / name)) for name in made]
    every = relational.order_detail(*tables)
    for order in (7, 47, 55, 99):
        one = relational.order_detail(*tables, order_id=order)
        assert _bag(one) == _bag(every.where(F.col("order_id") == order))
    plan = relational.order_detail(*tables, order_id=7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(order_id,7)") >= 3


def test_snapshot_counts_formats(spark):
    rows = [("flat_order_event",), ("flat_order_event",), ("unknown:a,b",), ("unknown:raw_text",), ("nested_order",)]
    events, formats = _events(spark, [("UNKNOWN", None, None, None, None, t) for t in range(5)]), spark.createDataFrame(rows, "format_name string")
    named = events.join(formats.select("format_name", (F.row_number().over(Window.orderBy("format_name")) - 1).alias("seq")), "seq")
    assert state.realtime_snapshot(named).first().event_formats == {"flat_order_event": 2, "nested_order": 1, "unknown": 2}
    assert state.realtime_snapshot(events).first().event_formats == {}


def test_snapshot_ages(spark):
    shown = spark.createDataFrame([("a", 5_000), ("a", 9_000), ("a", 0), ("b", None), ("b", -4)], "pipeline string, last_event_produced_at_ms long")
    got = {r.pipeline: tuple(r)[1:] for r in latency.snapshot_ages(shown, F.lit(8_000)).collect()}
    assert got == {"a": (3, 2, 0, 3_000), "b": (2, 0, None, None)}


def test_a_crowded_cell_is_dealt_to_tasks(spark, monkeypatch):
    """All restaurants and couriers in one cell, in one partition each: blocks of pairs go to several tasks, pairs stay."""
    monkeypatch.setattr(geo, "BLOCK_ROWS", 40, raising=False)
    r = random.Random(5)
    places = [(i, -23.5 + r.uniform(0, 0.2), -46.6 + r.uniform(0, 0.2)) for i in range(90)] + [(90, None, -46.6), (91, 40.0, 3.0)]
    free = [(i % 190, -23.5 + r.uniform(0, 0.2), -46.6 + r.uniform(0, 0.2)) for i in range(200)] + [(None, -23.5, -46.6), (500, -23.5, None)]
    limit = 0.2**2
    found = geo.geofence(
        spark.createDataFrame(places, "restaurant_id long, lat double, lon double").coalesce(1),
        spark.createDataFrame(free, "courier_id long, lat double, lon double").coalesce(1), limit,
    ).withColumn("task", F.spark_partition_id()).collect()
    near = lambda a, b: None not in (*a[1:], *b[1:]) and (b[1] - a[1]) * (b[1] - a[1]) + (b[2] - a[2]) * (b[2] - a[2]) < limit
    key = lambda p: (p[0], p[1] is None, p[1] or 0)
    want = sorted(((a[0], b[0]) for a in places for b in free if near(a, b)), key=key)
    assert sorted(((x.restaurant_id, x.courier_id) for x in found), key=key) == want and len(want) > 5000
    assert len({x.task for x in found}) > 1
