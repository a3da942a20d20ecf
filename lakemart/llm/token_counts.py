"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer, content, n_tokens): the digest of a tokenizer's file and
of the way its texts are normalised, the digest of a normalised text, and the text's token count.
Only texts whose pair of digests the cache lacks are encoded, each distinct text once.
"""

from __future__ import annotations

import functools
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import map_rows, new_table_path, stored, whole_texts

OVER_LIMIT = 512
#: Byte-level BPE has no normaliser: a null text counts as empty, all else stays as it is.
NORMALISATION = "null-as-empty"
CACHE_SCHEMA = "tokenizer string, content binary, n_tokens bigint"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others follow in order from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@functools.cache
def byte_level_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int], list[tuple[bytes, bytes]]]:
    """Tokens by bytes, special tokens by text, and merges in order, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    chars = byte_of_char()
    raw = lambda s: bytes(chars[c] for c in s)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return tokens, special, [(raw(a), raw(b)) for a, b in pairs]


def is_plain_byte_level(path: str) -> bool:
    """Whether ids follow the order of merges and nothing but byte-level BPE happens to a text."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        return False
    tokens, _, merges = byte_level_vocabulary(path)
    ids = [tokens[a + b] for a, b in merges]
    return ids == sorted(ids) and len(set(ids)) == len(ids) and all(tokens[bytes([b])] < ids[0] for b in range(256))


@functools.cache
def counter(path: str):
    """Function from texts to token counts, as the library of the file gives them.

    Plain byte-level files are run by tiktoken over the same vocabulary, as it is five times
    faster; a text that it refuses (its patterns backtrack) goes to the file's own library.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    library = lambda texts: [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]
    if not is_plain_byte_level(path):
        return library
    import public_tokenizers
    import tiktoken

    tokens, special, _ = byte_level_vocabulary(path)
    fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens, special_tokens=special)

    def count(texts: list[str]) -> list[int]:
        counts = []
        for text in texts:
            try:
                counts.append(len(fast.encode(text, allowed_special="all")))
            except (ValueError, RuntimeError):
                counts += library([text])
        return counts

    return count


def tokenizer_digest(path: str, normalisation: str = NORMALISATION) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + b"\0" + normalisation.encode()).hexdigest()


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer; two runs may have appended the same digest."""
    table = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return table.filter(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache: str, over_limit: int = OVER_LIMIT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    A null text counts as empty (0 tokens); repeated rows and repeated ids each keep their row; an
    empty table gives no rows; other columns are not read. Texts are never cut. The texts' digests
    are stored first; each distinct digest that the cache lacks is encoded for one of its rows
    (the smallest id), and the counts are appended before the result is read from the cache.
    Copies meet as digests only, so a text that a third of all rows share is encoded once.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    texts = whole_texts(docs, id_col, text_col).select(
        "doc_id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("content")
    )
    keys = stored(texts.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "token-keys")
    known = cached_counts(spark, cache, version)
    first = keys.groupBy("content").agg(F.min(F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("s"))
    missing = first.join(known, "content", "left_anti").select("content", F.col("s.col1").alias("first_id"))
    # Rows meet by id and digest: no two texts share a key but repeated rows, so none is hot.
    rows = texts.withColumn("first_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    encode = rows.join(missing, ["first_id", "content"], "left_semi").select("content", "text")

    def factory():
        count, seen = counter(tokenizer_path), set()

        def call(batch: list[dict]) -> list[tuple]:
            fresh = {r["content"]: r["text"] for r in batch if r["content"] not in seen}
            seen.update(fresh)
            return [(version, c, n) for c, n in zip(fresh, count([*fresh.values()]), strict=True)]

        return call

    map_rows(encode, CACHE_SCHEMA, factory=factory).write.mode("append").parquet(cache)
    return (
        keys.join(cached_counts(spark, cache, version), "content")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over_limit).alias("over_limit"))
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by byte_bpe_50k.json, from a cache that starts empty."""
    import public_tokenizers

    from lakemart.llm.common import documents

    cache = new_table_path(spark, "token-cache")
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), cache)
