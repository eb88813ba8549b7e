"""Line dedup by a log-template tree.

A line is parsed to a fixed depth: by its number of words and by its leading
``DEPTH`` words, words with a digit being variable from the start.  Inside such
a leaf, a word is constant at its place when enough different documents have
it there, else it is a variable field; constants and fields spell the line's
template.  A template that recurs across documents is dropped from all of
them, wherever it stands.

Recurring means: in at least ``witnesses`` different documents, however often
inside one document and whatever the number of copies.  Documents are told
apart by their own lines, those whose wording fewer than ``witnesses`` different texts
hold; documents with the same own lines, or with none, count as one.
So the lines of an article that was copied a thousand times are not mistaken
for boilerplate, unless ``witnesses`` of the copies have lines of their own
beside them; whole copies are left to the near-duplicate operator.  A template with
variable words needs ``fixed`` constants and as many again as a share of
``constant``.  A line under ``least`` words, as often a sentence as boilerplate,
is a leaf of its own and recurs in ``short`` different documents.

All lines are counted: constants and templates over the witnesses of every
wording (the words of a line, digit words alike) of their leaf.  Work is dealt by wording, leaf,
(leaf, place, word) and template, each counted with map-side combining; a
wording hands on ``short`` of its witnesses at most, which is all that its
words and its template need to recur, so a line that a third of all documents
hold costs no more than a rare one.

Defined results: null text stays null with no lines; lines without
words always stay; lines keep their order; repeated
rows of one id and text are one document for the counts and get equal results;
texts of any length are whole; an empty table gives no rows; ties cannot occur,
as all thresholds are on counts; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import batches_of, byte_set, hash_words, mix, only, ship, text_buffers
from vigil.session import BROAD, NARROW, materialize

DEPTH = 3
FIELD = "<*>"
_DIGIT = byte_set((48, 57))
_WORD, _NUMBER = re.compile(r"[^\x20\x09-\x0D]+"), re.compile("[0-9]")


@dataclass(frozen=True)
class Settings:
    least: int = 3          # words of a line that needs ``witnesses``; a shorter one needs ``short``
    witnesses: int = 10     # different documents of a recurring template
    short: int = 40         # different documents of a recurring line under ``least`` words
    fixed: int = 5          # constants of a template with variable words
    constant: float = 0.6   # and their share of its words


def parse_lines(column):
    """Vectorised parse of all lines with words: (document, line number, leaf, hash of the words
    with digit words alike)."""
    data, offsets = text_buffers(column)
    h, first, starts, ends = hash_words(data, offsets)
    z = np.zeros(0, np.int64)
    if not len(h):
        return z, z, z, z
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    word = np.where(digits[ends] > digits[starts], np.uint64(1), h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = breaks[starts] + doc  # documents follow each other without a line end
    new = np.ones(len(h), bool)
    new[1:] = line[1:] != line[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(h)))
    leaf = size.astype(np.uint64)
    for i in range(DEPTH):
        inside = size > i
        leaf = mix(leaf * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, word[np.minimum(at + i, len(word) - 1)], 0))
    place = (np.arange(len(word)) - np.repeat(at, size)).astype(np.uint64)
    mark = mix(np.add.reduceat(mix(word + place * np.uint64(0x9E3779B97F4A7C15)), at))
    number = breaks[starts[at]] - breaks[offsets[doc[at]]]
    return doc[at], number, leaf.view(np.int64), mark.view(np.int64)


def masked(line: str) -> list[str]:
    """Words of a line, those with a digit as variable fields."""
    return [FIELD if _NUMBER.search(w) else w for w in _WORD.findall(line)]


def line_templates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Lines with recurring templates: doc_id, text_hash, line, leaf, template."""
    s = settings
    ship(docs.sparkSession)
    d = docs.selectExpr("cast(doc_id as long) doc_id", "xxhash64(cast(text as string)) text_hash",
                        "cast(text as string) text").where("text is not null")

    def leaves(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in it:
            for part in batches_of(batch, "text"):
                doc, number, leaf, mark = parse_lines(part.column(2))
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(number, pa.int64()),
                     pa.array(leaf, pa.int64()), pa.array(mark, pa.int64())],
                    names=["doc_id", "text_hash", "line", "leaf", "mark"])

    parsed = materialize(d.mapInArrow(leaves, "doc_id long, text_hash long, line long, leaf long, mark long"), "lines")
    held = materialize(parsed.select("leaf", "mark", "text_hash").distinct(), "held", BROAD)
    # a text is told apart by the lines that it shares with less than ``witnesses`` texts
    often = materialize(held.groupBy("leaf", "mark").agg(F.count("*").alias("w")).where(F.col("w") >= s.witnesses)
                        .select("leaf", "mark"), "often", NARROW)
    own = (held.join(often, ["leaf", "mark"], "left_anti").groupBy("text_hash")
           .agg(F.bit_xor(F.xxhash64("mark")).alias("own")))
    full = held.groupBy("leaf").agg(F.count("*").alias("w")).where(F.col("w") >= s.witnesses).select("leaf")
    seen = materialize(held.join(full, "leaf").join(own, "text_hash", "left")
                       .select("leaf", "mark", F.coalesce("own", F.lit(0)).alias("witness")).distinct(), "seen", BROAD)
    busy = materialize(seen.select("leaf", "witness").distinct().groupBy("leaf").agg(F.count("*").alias("w"))
                       .where(F.col("w") >= s.witnesses).select("leaf"), "leaves", NARROW)
    # so many witnesses of each line tell whether its words and template have enough, as all of a rarer line are here
    first = Window.partitionBy("leaf", "mark").orderBy("witness")
    some = (seen.join(busy, "leaf").withColumn("r", F.row_number().over(first))
            .where(F.col("r") <= max(s.witnesses, s.short)).groupBy("leaf", "mark").agg(F.collect_set("witness").alias("seen")))
    # one line of each wording gives its words
    near = (parsed.join(busy, "leaf").groupBy("leaf", "mark").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("at"))
            .select(F.col("at.doc_id").alias("i"), F.col("at.text_hash").alias("h"), F.struct("at.line", "leaf", "mark").alias("m"))
            .groupBy("i", "h").agg(F.collect_set("m").alias("marks")))

    def words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from vigil.llm.templates import masked

        for batch in it:
            for part in batches_of(batch, "text"):
                rows = []
                for text, marks in zip(*(c.to_pylist() for c in part.columns)):
                    lines = text.split("\n")
                    rows += [(m["leaf"], m["mark"], masked(lines[m["line"]])) for m in marks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int64()) for k in range(2)]
                    + [pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["leaf", "mark", "words"])

    wordings = (d.join(near, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")))
                .dropDuplicates(["doc_id", "text_hash"]).select("text", "marks")
                .mapInArrow(words, "leaf long, mark long, words array<string>"))
    wordings = materialize(wordings.join(some, ["leaf", "mark"]), "words", BROAD)

    # constants and templates are counted over the witnesses of all lines
    long = F.size("words") >= s.least
    spread = wordings.where(long).select("leaf", "mark", "seen", F.posexplode("words").alias("place", "word"))
    constant = (spread.select("leaf", "place", "word", F.explode("seen").alias("w")).distinct()
                .groupBy("leaf", "place", "word").agg(F.count("*").alias("w")))
    constant = materialize(constant.where(F.col("w") >= s.witnesses).select("leaf", "place", "word", F.lit(True).alias("is")),
                           "constants", NARROW)
    pattern = F.transform(F.array_sort(F.collect_list(F.struct("place", F.when(F.col("is"), F.col("word")).alias("word")))),
                          lambda p: p["word"])
    spelled = (spread.drop("seen").join(constant, ["leaf", "place", "word"], "left")
               .groupBy("leaf", "mark").agg(pattern.alias("pattern")))
    n_fixed = F.size(F.filter("pattern", lambda w: w.isNotNull()))
    allowed = (n_fixed == F.size("pattern")) | ((n_fixed >= s.fixed) & (n_fixed >= s.constant * F.size("pattern")))
    templates = (spelled.where(allowed).join(wordings.select("leaf", "mark", "seen"), ["leaf", "mark"])
                 .select("leaf", "pattern", F.explode("seen").alias("w")).distinct()
                 .groupBy("leaf", "pattern").agg(F.count("*").alias("w")))
    # a line under ``least`` words is a leaf of its own
    brief = wordings.where(~long & (F.size("seen") >= s.short)).select("leaf", F.col("words").alias("pattern"))
    templates = materialize(templates.where(F.col("w") >= s.witnesses).select("leaf", "pattern").unionByName(brief), "templates", NARROW)
    # each wording is spelled under each mask of variable words of its leaf, and looked up by that spelling
    spelled_as = lambda words: F.array_join(words, " ", "\t")  # noqa: E731 (neither sign occurs in a word)
    masks = templates.select("leaf", F.transform("pattern", lambda w: w.isNull()).alias("mask")).distinct()
    under = F.zip_with("words", "mask", lambda w, free: F.when(~free, w))
    asked = wordings.join(masks, "leaf").where(F.size("words") == F.size("mask")).select("leaf", "mark", spelled_as(under).alias("as"))
    matched = materialize(asked.join(templates.select("leaf", "pattern", spelled_as("pattern").alias("as")), ["leaf", "as"])
                          .select("leaf", "mark", "pattern"), "matched", NARROW)
    spelling = F.array_join("pattern", " ", FIELD).alias("template")
    return parsed.join(matched, ["leaf", "mark"]).select("doc_id", "text_hash", "line", "leaf", spelling)


def drop_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs`` with recurring lines taken out of ``text``; adds n_lines and n_dropped as a struct
    column ``__lines``, in place of an input column of that name."""
    gone = (line_templates(docs, settings).groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("gone"))
            .select(F.struct("doc_id", "text_hash").alias("__key"), "gone"))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), key.alias("__own"))
    j = packed.join(gone, F.col("__own").eqNullSafe(F.col("__key")), "left")
    lines = F.split(F.col("__row.text").cast("string"), "\n", -1)
    # the stretches between dropped lines; both arrays are bound once for all stretches
    both = F.array(F.struct(lines.alias("lines"), F.array_sort("gone").alias("gone")))
    left = F.transform(both, lambda b: F.flatten(F.transform(F.sequence(F.lit(0), F.size(b["gone"])), lambda i: F.slice(
        b["lines"], F.coalesce(F.get(b["gone"], i - 1).cast("int") + 1, F.lit(0)) + 1,
        F.coalesce(F.get(b["gone"], i).cast("int"), F.size(b["lines"]))
        - F.coalesce(F.get(b["gone"], i - 1).cast("int") + 1, F.lit(0))))))
    text = F.when(F.col("gone").isNull(), F.col("__row.text")).otherwise(F.array_join(F.element_at(left, 1), "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c != "__lines"]
    return j.select(*columns, F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")).alias("__lines"))
