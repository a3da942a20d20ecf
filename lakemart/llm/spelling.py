"""Spelling variants: words one edit apart are found by asymmetric q-chunks.

Take two words, the longer one by at most one letter. Cut the shorter one into two disjoint chunks.
One edit leaves one of them whole: the first in the same place of the longer word, or the second in
the same place (a replaced letter) or one further on (an inserted one). So every word contributes
its two chunks in one role, and in the other role its positional grams of those lengths, of which
only the places that a chunk can reach within this shift are sent. The two roles are joined, and
what remains beside the common chunk is verified to be one edit apart.

A chunk that too many words share is cut again: the edit lies in the rest, and leaves one of the
two chunks of the rest whole. Where the rest is one letter, a key has no more words than there are
letters. So no key is hot, and no word or pair is left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import documents, stored, whole_texts

#: Letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form occurs at least so many times as often as its variant.
DOMINANCE = 5
#: A run loses a letter where this divides the crc32 of '<doc_id>:<run>'.
DELETE_MODULUS = 199
#: Distinct words that a task counts before it sends the counts on.
HELD = 200_000
#: Pairs of words that one key of chunks may bring together.
PAIRS_OF_KEY = 1_000_000


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, delete_modulus: int = DELETE_MODULUS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, n) of the runs of letters of all documents, lower-cased in A-Z, with the stated deletions.

    Runs shorter than ``least_length`` cannot become words of that length and are not counted. Tasks
    count before the shuffle, in tables of bounded size.
    """
    run_of = re.compile(f"[{LETTERS}]{{{least_length},}}")  # a maximal run, if it is long enough

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                text = raw.lower().decode()  # of bytes: only A-Z
                for word, times in Counter(run_of.findall(text)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_modulus == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += times
                if len(held) >= HELD:
                    yield sent()
        if held:
            yield sent()

    counted = whole_texts(docs, id_col, text_col).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def in_roles(words: DataFrame, least_length: int) -> DataFrame:
    """(key, longer, word, n, rest): each word in both roles, for pairs of equal length and of lengths one apart.

    A key starts with the shorter word's length and by how much the other is longer.
    """
    length = F.length("word")
    key = lambda less, more: F.concat((length - less).cast("string"), F.lit(f"+{more}"))
    roles = F.array(
        F.struct(key(0, 0).alias("key"), F.lit(False).alias("longer")),
        F.struct(key(0, 1).alias("key"), F.lit(False).alias("longer")),
        F.struct(key(0, 0).alias("key"), F.lit(True).alias("longer")),
        F.struct(key(1, 1).alias("key"), F.lit(True).alias("longer")),
    )
    dealt = words.select("word", "n", F.explode(roles).alias("role"))
    useful = ~F.col("role.longer") | (F.col("role.key") != F.lit(f"{least_length - 1}+1"))
    return dealt.filter(useful).select("role.key", "role.longer", "word", "n", F.col("word").alias("rest"))


def cut(rows: DataFrame) -> DataFrame:
    """``rows`` once for each chunk of their rest: the chunk joins the key, the other side is the new rest."""
    # The shorter word's rest; its lengths are what both roles cut by.
    size = F.length("rest") - F.when(F.col("longer"), F.substring_index(F.substring_index("key", "/", 1), "+", -1).cast("int")).otherwise(0)
    half = F.floor(size / 2).cast("int")
    head = lambda n: F.expr(f"substring(rest, 1, {n})")
    tail = lambda n: F.expr(f"substring(rest, length(rest) - ({n}) + 1)")
    sized = rows.withColumn("half", half).withColumn("size", size)
    sides = F.array(
        F.struct(F.concat("key", F.lit("/0"), head("half")).alias("key"), tail("length(rest) - half").alias("rest")),
        F.struct(F.concat("key", F.lit("/1"), tail("size - half")).alias("key"), head("length(rest) - size + half").alias("rest")),
    )
    return sized.select(F.explode(sides).alias("side"), "longer", "word", "n").select("side.key", "longer", "word", "n", "side.rest")


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH, pairs_of_key: int = PAIRS_OF_KEY) -> DataFrame:
    """(a, a_n, b, b_n): each pair of distinct ``words`` (word, n) that differ by exactly one code point, once."""
    rows = stored(cut(in_roles(words, least_length)), "chunks")
    found = None
    while True:
        sizes = rows.groupBy("key").agg(
            F.count_if(~F.col("longer")).alias("short"), F.count_if("longer").alias("long"),
            F.max(F.when(~F.col("longer"), F.length("rest"))).alias("left"),
        )
        hot = sizes.filter((F.col("short") * F.col("long") > pairs_of_key) & (F.col("left") > 1)).select("key")
        hot = stored(hot, "hot-chunks")
        some_hot = not hot.isEmpty()
        ready = rows.join(hot, "key", "left_anti") if some_hot else rows
        a = ready.filter(~F.col("longer")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("rest").alias("a_rest"))
        b = ready.filter("longer").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"))
        ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        one_edit = F.levenshtein("a_rest", "b_rest", 1) == 1
        pairs = stored(a.join(b, "key").filter(ordered & one_edit).select("a", "a_n", "b", "b_n"), "near-words")
        found = pairs if found is None else found.unionByName(pairs)
        if not some_hot:
            return found.distinct()
        rows = stored(cut(rows.join(hot, "key", "left_semi")), "chunks")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms of ``forms`` (word, form) ends, by doubling the steps.

    A form is DOMINANCE times as frequent as its word, so there are no cycles and few rounds.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = stored(
            at.join(after, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def spelling_variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, dominance: int = DOMINANCE,
    delete_modulus: int = DELETE_MODULUS, pairs_of_key: int = PAIRS_OF_KEY, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``least_length`` letters and ``least_count`` occurrences.

    A word's form is the most frequent word one edit away, the first in code-point order of equally
    frequent ones, if it is ``dominance`` times as frequent as the word. A null text has no words; a
    null id counts as the empty text where deletions are drawn. Repeated rows count each. Texts are
    read whole, words of any length kept whole. No word, no row. Other columns are not read.
    """
    words = word_counts(docs, least_length, delete_modulus, id_col, text_col).filter(F.col("n") >= least_count)
    words = stored(words, "words")
    pairs = near_pairs(words, least_length, pairs_of_key)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )).alias("x")).select("x.*")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    with_form = F.col("best.less") * -1 >= F.col("n") * dominance
    formed = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(with_form, F.col("best.other")).alias("form"), F.when(with_form, -F.col("best.less")).alias("form_n"),
        ),
        "words-with-forms",
    )
    roots = roots_of(formed.filter("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent forms."""
    return spelling_variants(documents(spark, sf_dir))
