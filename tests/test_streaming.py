
from datetime import timedelta

import pandas as pd

from conftest import rows_of
from granary.operators import loads
from granary.sources import landing, store
from granary.streaming import arrivals
from test_landing import deliver


def test_each_file_is_handled_once(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    incoming, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = arrivals.stream_landing(spark, str(incoming), schema, files_per_batch=1)
        arrivals.run_available(stream, mark, arrivals.append_once(out))

    deliver(incoming, "20240101", "S", "a", txt="1#&x\n2#&y\n")
    deliver(incoming, "20240101", "S", "b", txt="3#&z\n", END="1")
    run()
    run()
    assert rows_of(spark.read.orc(out).select("id", "v")) == [(1, "x"), (2, "y"), (3, "z")]
    deliver(incoming, "20240102", "S", "c", txt="4#&w\n")
    run()
    got = spark.read.orc(out)
    assert got.count() == 4 and got.select("batch_id").distinct().count() == 3


def test_replayed_batch_replaces_itself(spark, tmp_path):
    handle = arrivals.append_once(str(tmp_path / "o"))
    handle(spark.range(3), 0)
    handle(spark.range(5), 1)
    handle(spark.range(3), 0)
    assert spark.read.orc(str(tmp_path / "o")).count() == 8


def test_deliveries_start_with_their_end_file(spark, tmp_path):
    """Bundles are loaded by key as their END files arrive; replays change nothing."""
    incoming, root, mark = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "mark")
    schema = spark.createDataFrame([], "id int, v string").schema

    def handle(batch, batch_id):
        for row in batch.toLocalIterator():
            src = landing.read_landing(spark, row.path.replace(".END", ".txt"), schema)
            assert src.count() == row.expected
            tgt = store.read_table(spark, root) if store.table_exists(spark, root) else None
            store.publish(loads.apply_load(src, tgt, "update", row.etl_date, ["id"]), root)

    deliver(incoming, "20240101", "S", "a", txt="1#&x\n2#&y\n", END="2")
    deliver(incoming, "20240102", "S", "b", txt="2#&z\n")
    arrivals.run_available(arrivals.stream_ready(spark, str(incoming), 1), mark, handle)
    assert rows_of(store.read_table(spark, root)) == [(1, "x"), (2, "y")]
    deliver(incoming, "20240102", "S", "b", END="1")
    arrivals.run_available(arrivals.stream_ready(spark, str(incoming), 1), mark, handle)
    assert rows_of(store.read_table(spark, root)) == [(1, "x"), (2, "z")]


def test_deliveries_are_ready_once(spark, tmp_path):
    """Late, partial, repeated and blank ones over several runs."""
    incoming, notes, receipts = tmp_path / "in", tmp_path / "notes", str(tmp_path / "receipts")
    notes.mkdir()
    schema = spark.createDataFrame([], "id int, v string").schema
    loaded, seen = [], []

    def load(ready, batch_id):
        loaded.extend((r.name, r.id, r.expected) for r in arrivals.ready_rows(ready, schema).collect())

    handler = arrivals.load_ready(receipts, load)

    def handle(batch, batch_id):
        seen.extend((r.name, r.status) for r in batch.collect())
        handler(batch, batch_id)

    def run():
        arrivals.note_blank_ends(spark, str(incoming), str(notes))
        stream = arrivals.stream_deliveries(spark, str(incoming), str(notes), timedelta(hours=1))
        arrivals.run_available(stream, str(tmp_path / "mark"), handle, "update")

    deliver(incoming, "20240101", "S", "whole", txt="1#&x\n", SQL="s", END="1")
    deliver(incoming, "20240101", "S", "late", txt="2#&x\n", SQL="s")
    deliver(incoming, "20240101", "S", "part", SQL="s", END="4")
    deliver(incoming, "20240101", "S", "blank", txt="3#&x\n", SQL="s", END="")
    run()
    assert sorted(loaded) == [("blank", 3, -1), ("whole", 1, 1)]
    deliver(incoming, "20240101", "S", "late", END="1")
    deliver(incoming / "20240101" / "S", "whole", "", "whole", END="1")
    run()
    run()
    assert sorted(loaded) == [("blank", 3, -1), ("late", 2, 1), ("whole", 1, 1)]
    assert ("whole", "repeated") in seen and seen.count(("whole", "ready")) == 1 and ("part", "waiting") in seen


def test_a_replayed_batch_loads_the_same(spark, tmp_path):
    loaded = []
    handle = arrivals.load_ready(str(tmp_path / "r"), lambda ready, i: loaded.append((i, ready.count())))
    rows = [("d", "s", n, "ready" if n != "c" else "waiting", "e", "q", "t") for n in "abc"]
    batch = spark.createDataFrame(rows, arrivals.DELIVERY)
    handle(batch, 4)
    handle(batch, 4)
    handle(batch, 5)  # delivered again after its state was forgotten
    assert loaded == [(4, 2), (4, 2)]


def test_waiting_deliveries_become_late():
    from granary.streaming.arrivals import delivery_step

    class State:
        exists, hasTimedOut, now = False, False, 0

        def getCurrentWatermarkMs(self):
            return self.now

        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutTimestamp(self, at):
            self.at = at

        def remove(self):
            self.exists = False

    step, state, key = delivery_step(1000), State(), ("d", "s", "n")

    def files_at(millis, *kinds):
        state.hasTimedOut = not kinds
        frame = pd.DataFrame([(k, f"/{k}", millis) for k in kinds], columns=["kind", "path", "millis"])
        state.now = millis
        return [r.status.iloc[0] for r in step(key, iter([frame] if kinds else []), state)]

    assert files_at(50, "SQL") == ["waiting"] and state.at == 1050
    assert files_at(1200) == ["late"] and state.at == 2200
    assert files_at(1300, "END", "txt") == ["ready"]
    assert files_at(1400, "END") == ["repeated"] and state.at == 2400
    assert files_at(2500) == [] and not state.exists
