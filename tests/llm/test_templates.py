import random
import time
from collections import Counter

from vigil.llm.templates import DEPTH, Settings, drop_lines, line_templates, masked


def corpus():
    """Documents of unique prose, with boilerplate from 30 of them, and a copied article."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    prose = lambda: " ".join(word() for _ in range(rng.randrange(4, 12)))
    article = [prose() for _ in range(5)]
    docs = []
    for d in range(120):
        lines = [prose() for _ in range(rng.randrange(1, 5))]
        if d % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), f"Licensed under the rules of version {rng.randrange(100)}")
        if d % 4 == 1:
            lines.append(f"Posted in the {word()} forum of all members")
        if d % 4 == 2:
            lines.append("Too short")
        docs.append((d, "\n".join(lines)))
    docs += [(1000 + i, "\n".join(article)) for i in range(60)]
    return docs


def test_recurring_templates_go_and_prose_stays(spark):
    docs = corpus()
    out = drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "text", "__lines.*").collect()
    by = {r.doc_id: r for r in out}
    for d, text in docs:
        want = [x for x in text.split("\n") if not x.startswith(("Licensed under", "Posted in"))]
        assert by[d].text == "\n".join(want), (d, by[d].text)
        assert (by[d].n_lines, by[d].n_dropped) == (len(text.split("\n")), len(text.split("\n")) - len(want))


def brute_templates(docs, s):
    """The same definitions in plain Python: all lines of all texts, witnesses as sets of lines."""
    texts = {t: {tuple(masked(x)) for x in t.split("\n")} - {()} for _, t in docs}
    holders = Counter(w for held in texts.values() for w in held)
    seen = {}
    for held in texts.values():
        witness = frozenset(w for w in held if holders[w] < s.witnesses)
        for w in held:
            seen.setdefault(w, set()).add(witness)
    leaf = lambda w: (len(w), w[:DEPTH])
    words, patterns = {}, {}
    for w, witnesses in seen.items():
        for i, x in enumerate(w):
            words.setdefault((leaf(w), i, x), set()).update(witnesses)
    for w, witnesses in seen.items():
        p = tuple(x if len(words[leaf(w), i, x]) >= s.witnesses else None for i, x in enumerate(w))
        patterns.setdefault((leaf(w), p), set()).update(witnesses)
    found = {" ".join(w) for w, x in seen.items() if len(w) < s.least and len(x) >= s.short}
    for (_, p), witnesses in patterns.items():
        constants = sum(x is not None for x in p)
        if len(p) >= s.least and len(witnesses) >= s.witnesses and (
                constants == len(p) or constants >= s.fixed and constants >= s.constant * len(p)):
            found.add(" ".join(x or "<*>" for x in p))
    return found


def busy_corpus(seed):
    """Many lines of few leaves in each document, with templates of several masks, copies and short lines."""
    rng = random.Random(seed)
    pick = lambda n: rng.choice("abcdefghijklmnop"[:n])
    docs = []
    for d in range(150):
        lines = [f"own line {d} " + " ".join(pick(16) * rng.randrange(1, 4) for _ in range(4)) for _ in range(rng.randrange(3))]
        lines += [f"one two three {pick(3)} {pick(16)} {pick(2)} {pick(16)} nine ten" for _ in range(rng.randrange(6))]
        lines += [f"one two three {pick(16)} {pick(2)} seven eight" for _ in range(rng.randrange(4))]
        lines += [rng.choice(["Read more", "Menu", f"page {d}", ""]) for _ in range(rng.randrange(3))]
        docs.append((d, "\n".join(lines)))
    return docs + [(500 + i, docs[i % 7][1]) for i in range(40)]


def test_templates_equal_the_plain_version(spark):
    found = lambda docs: {r.template for r in line_templates(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    docs = corpus()
    assert found(docs) == brute_templates(docs, Settings()) == {
        "Licensed under the rules of version <*>", "Posted in the <*> forum of all members"}
    for seed in (1, 2):
        docs = busy_corpus(seed)
        want = brute_templates(docs, Settings())
        assert len(want) > 2
        assert found(docs) == want


def test_time_follows_the_dropped_lines_of_one_document(spark):
    def seconds(n):
        others = [(i, f"own{i} words{'abcdefghijkl'[i % 12] * (i + 1)} here only once") for i in range(12)]
        boiler = [f"All rights reserved by the {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} owners" for i in range(100)]
        docs = [(d, t + "\n" + "\n".join(boiler)) for d, t in others]
        docs.append((99, "start of a long text\n" + "\n".join(boiler[i % 100] for i in range(n))))
        df = spark.createDataFrame(docs, "doc_id long, text string")
        began = time.perf_counter()
        left = {r.doc_id: r.text for r in drop_lines(df).select("doc_id", "text").collect()}
        assert left == {**dict(others), 99: "start of a long text"}
        return time.perf_counter() - began

    seconds(100)
    assert seconds(100_000) < 2.5 * seconds(50_000) + 2


def test_odd_documents(spark, odd_docs, no_docs):
    out = drop_lines(odd_docs)
    assert out.columns == odd_docs.columns + ["__lines"]
    key = lambda r: (str(r.doc_id), str(r.text))
    assert sorted(map(key, out.collect())) == sorted(map(key, odd_docs.collect()))
    assert out.where("text is null").select("__lines.n_lines").first()[0] == 0
    assert drop_lines(no_docs).count() == 0


def test_repeated_rows_and_long_lines(spark):
    docs = [(i, f"unique{i} words{i} here{i} only{i} {'abcdefg'[i % 7] * i}\nAll rights reserved by us") for i in range(30)]
    docs += [docs[0]] * 5 + [(99, "All rights reserved by us\n" + "y " * 200_000)]
    rows = drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs) and not any("All rights" in r.text for r in rows)


def rest_of(spark, docs, gone):
    """Compares what is left of ``docs`` with their lines that ``gone`` doesn't name."""
    for r in drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert r.text == "\n".join(x for x in dict(docs)[r.doc_id].split("\n") if not gone(x)), r.doc_id


def proses(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    return word, lambda: " ".join(word() for _ in range(9))


def test_lines_of_one_leaf_do_not_hide_each_other(spark):
    word, prose = proses(8)
    share = ["Share this on Facebook", "Share this on Twitter"]
    docs = [(i, "\n".join([prose(), *share, f"Share this on {word()}"])) for i in range(30)]
    rest_of(spark, docs, lambda x: x in share)


def test_repeats_and_copies_do_not_outweigh_documents(spark):
    word, prose = proses(9)
    bar, line = "Reply Share Report", "All of this was printed with permission"
    copy = "\n".join([prose(), line, prose()])
    docs = [(i, "\n".join([prose(), *[bar] * 30])) for i in range(15)]
    docs += [(100 + i, copy) for i in range(300)] + [(1000 + i, f"{prose()}\n{line}") for i in range(12)]
    rest_of(spark, docs, lambda x: x in (bar, line))


def test_log_lines_go_and_a_log_is_one_document(spark):
    word, prose = proses(10)
    log = lambda what: "\n".join(f"{i} {i} INFO {word()} job {what} by the night shift" for i in range(60))
    docs = [(i, f"{prose()}\n{log('done')}") for i in range(20)] + [(50, f"{prose()}\n{log('left')}")]
    rest_of(spark, docs, lambda x: "job done" in x)


def test_pages_of_long_shared_boilerplate_are_different(spark):
    word, prose = proses(11)
    frame = [prose() for _ in range(26)]
    docs = [(i, "\n".join([*frame[:13], prose(), *frame[13:]])) for i in range(12)]
    rest_of(spark, docs, lambda x: x in frame)


def test_short_lines_go_when_many_documents_hold_them(spark):
    word, prose = proses(12)
    docs = [(i, "\n".join([prose(), "Read more", "Share", "Rare words" if i < 20 else prose()])) for i in range(50)]
    docs += [(100 + i, f"{docs[0][1]}\nCopied text") for i in range(60)]
    rest_of(spark, docs, lambda x: x in ("Read more", "Share"))
