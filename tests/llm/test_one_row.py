"""Work grows with the length of one conversation, page or text, not with its square."""

import time

from vigil.llm.chat import digest, reconstruct, render
from vigil.llm.dom import read
from vigil.llm.toxicity import FEATURES, Automaton, Settings, _quoted_spans, features


def slower(run, n, slack=1.0):
    """Seconds at twice the size against those at n; a square would take four times as long."""
    times = []
    for size in (n, 2 * n):
        began = time.perf_counter()
        run(size)
        times.append(time.perf_counter() - began)
    assert times[1] < 3 * times[0] + slack, times


def test_conversation(spark):
    def run(n):
        events = spark.range(n).selectExpr("1L conv_id", "id seq", "if(id % 7 = 3, 'delta', 'message') event", "id div 2 message_id",
                                           "if(id div 2 % 2 = 0, 'user', 'assistant') role", "concat('text é ', id) text")
        row = digest(render(reconstruct(events))).collect()
        assert len(row) == 1 and row[0].n_turns == n // 2

    run(100)
    slower(run, 100_000, 4.0)


def test_page():
    for page in (lambda n: "<p>text" + "<b>" * n + "</i>" * n, lambda n: "<font>x" * n + "<div>y" * n,
                 lambda n: "<i><table>" + "<b>" * n + "</i>" * n, lambda n: "<li>x<b>" * n, lambda n: "<div>" * n + "</p>" * n,
                 lambda n: "<table>" + "<tr><td>a<u>" * n):
        slower(lambda n: read(page(n)), 50_000)


def test_text():
    bad = Automaton(["zork"], [])
    for text in (lambda n: "say \"zork\" or zork. " * n, lambda n: "“zork " * n, lambda n: "« zork\n" * n):
        slower(lambda n: features(text(n), {}, bad, Settings()), 25_000)
    assert len(features("zork", {}, bad, Settings())) == len(FEATURES)


def test_quotations_end_in_their_line():
    text = 'a "b" “c” „d “e” "f\ng" «h» “i'
    assert [text[a:b + 1] for a, b in _quoted_spans(text)] == ['"b"', "“c”", "„d “", "«h»"]
