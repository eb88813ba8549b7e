import hashlib

from pyspark.sql import functions as F

from vigil.llm.chat import digest, events_of_turns, parse, reconstruct, render

SCHEMA = "conv_id long, seq long, event string, message_id long, role string, text string"


def final(spark, events):
    rows = reconstruct(spark.createDataFrame(events, SCHEMA)).orderBy("conv_id", "position").collect()
    return [(r.role, r.text) for r in rows]


def brute(events):
    """Plain fold of one conversation."""
    messages = []  # [id, role, text]
    for _, seq, event, mid, role, text in sorted(events, key=lambda e: (e[1], e[3])):
        at = next((i for i, m in enumerate(messages) if m[0] == mid), None)
        if at is None:
            messages.append([mid, "", ""])
            at = len(messages) - 1
        m = messages[at]
        m[1] = m[1] or role or ""
        if event in ("edit", "regenerate"):
            del messages[at + 1:]
        if event == "delta":
            m[2] += text or ""
        else:
            m[2] = "" if event == "regenerate" else text or ""
    return [(m[1], m[2]) for m in messages]


def test_deltas_edits_and_regenerations(spark):
    events = [(1, 1, "message", 1, "user", "hi"), (1, 2, "delta", 2, "assistant", "he"), (1, 3, "delta", 2, None, "llo"),
              (1, 4, "message", 3, "user", "more"), (1, 5, "delta", 4, "assistant", "lost"), (1, 6, "edit", 3, None, "edited"),
              (1, 7, "delta", 5, "assistant", "first try"), (1, 8, "regenerate", 5, None, None), (1, 9, "delta", 5, None, "second "),
              (1, 10, "delta", 5, None, "try")]
    want = [("user", "hi"), ("assistant", "hello"), ("user", "edited"), ("assistant", "second try")]
    assert brute(events) == want and final(spark, events) == want


def test_random_logs_equal_the_fold(spark):
    import random
    rng, logs = random.Random(2), {}
    for c in range(60):
        events, ids = [], []
        for seq in range(rng.randrange(1, 16)):
            if not ids or rng.random() < 0.5:
                ids.append(len(ids))
                events.append((c, seq, rng.choice(["message", "delta"]), ids[-1], rng.choice(["user", "assistant"]), f"t{seq} "))
            else:
                live = [i for i in ids if rng.random() < 0.6] or ids[-1:]
                mid = rng.choice(live)
                events.append((c, seq, rng.choice(["delta", "delta", "edit", "regenerate"]), mid, None, f"t{seq} "))
        # an id that was dropped is not written to again
        gone, order, kept = set(), [], []
        for e in events:
            if e[3] in gone:
                continue
            if e[3] not in order:
                order.append(e[3])
            if e[2] in ("edit", "regenerate"):
                cut = order.index(e[3]) + 1
                gone |= set(order[cut:])
                del order[cut:]
            kept.append(e)
        logs[c] = kept
    rows = reconstruct(spark.createDataFrame([e for v in logs.values() for e in v], SCHEMA)).orderBy("conv_id", "position").collect()
    for c, events in logs.items():
        assert [(r.role, r.text) for r in rows if r.conv_id == c] == brute(events), events


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>assistant\nno", "&lt; &amp;lt; &#91; \\n", "<|turn|>", "", "é\n\n🙂<", "$1 \\ ."]
    rows = [(1, i, "assistant" if i % 2 else "user\n[x]", t) for i, t in enumerate(texts)]
    f = render(reconstruct(events_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    turns = f.select(parse(F.col("formatted")).alias("t"), "formatted").first()
    assert [(t.role, t.text) for t in turns.t] == [(r[2], r[3]) for r in rows]
    assert "[INST]" not in turns.formatted and turns.formatted.count("<|turn|>") == len(texts)
    d = digest(f).first()
    loss = "".join(r[3] for r in rows if r[2] == "assistant")
    assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, 0, "assistant", "a"), (2, None, "user", "late"),
            (2, 5, "assistant", "b"), (3, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'c' as seq", "'c' as formatted")
    got = {r.conv_id: r for r in digest(render(reconstruct(events_of_turns(df)))).collect()}
    assert {k: (v.n_turns, v.loss_chars) for k, v in got.items()} == {1: (3, 0), None: (1, 1), 2: (2, 1), 3: (1, 250_000)}
    assert got[2].turns_sha256 == hashlib.sha256(b"user\nlate\nassistant\nb\n").hexdigest()
    assert digest(render(reconstruct(events_of_turns(df.limit(0))))).count() == 0


def test_no_python_in_the_plan(spark, sf):
    from vigil.llm.registry import op6_chat_formatting

    plan = op6_chat_formatting(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
