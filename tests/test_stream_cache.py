import datetime
import random
import time

from quaestor.streaming import cache
from quaestor.streaming.logs import drained

SCHEMA = "key string, id bigint, at timestamp, op string, body string, ttl_s bigint"
START = datetime.datetime(2026, 1, 1)


def plain(events):
    held, out = {}, set()
    for key, i, at, op, body, ttl in sorted(events, key=lambda e: (e[2], e[1])):
        if key in held and held[key][1] < at:
            out.add((key, None, held[key][1], "purged", None, held.pop(key)[2]))
        if op == "put":
            if body:
                held[key] = [body, at + datetime.timedelta(seconds=ttl), 0]
        elif key in held:
            held[key][2] += 1
            out.add((key, i, at, "hit", held[key][0], held[key][2]))
        else:
            out.add((key, i, at, "miss", None, 0))
    left = {(k, None, v[1], "purged", None, v[2]) for k, v in held.items()}
    return out, left


def test_replayed_events_answer_as_a_plain_cache_does_after_a_restart_too(spark, tmp_path):
    rng = random.Random(1)
    events, at = [], START
    for i in range(240):
        at += datetime.timedelta(seconds=rng.randrange(0, 20))
        put = rng.random() < 0.4
        events.append((f"k{rng.randrange(6)}", i, at, "put" if put else "get", rng.choice(["", f"body{i}", f"body{i}"]) if put else None, rng.choice([0, 30, 120]) if put else None))
    path, got = str(tmp_path / "in"), []
    for part in range(3):  # three runs of the same query, each with what has landed since
        spark.createDataFrame(events[80 * part : 80 * part + 80], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.1)
        with cache.keyed_state(spark):
            stream = cache.answered(spark.readStream.schema(SCHEMA).parquet(path))
            got += [tuple(r) for r in drained(stream, f"run{part}", "append", str(tmp_path / "checkpoint")).collect()]
    want, left = plain(events)
    assert len(got) == len(set(got))
    assert want <= set(got) and set(got) - want <= left
    last = max(e[2] for e in events)
    # timers purge what no event of its key has met, once the watermark is past it
    assert {x for x in left if x[2] < last - datetime.timedelta(seconds=1)} <= set(got)
    assert {x[3] for x in got} == {"hit", "miss", "purged"}
