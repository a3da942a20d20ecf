"""Byte-level BPE by prefix-sharing traversal of a trie of distinct words.

The state of a trie node is the last token of the encoding of its prefix. It follows from the
states above it: of the tokens that end the prefix, exactly one starts where a state above ends
and does not merge across that border. A depth-first walk computes each state once for all words
that share the prefix; walking the distinct words in byte order visits the trie in that order,
so that only the path to the current word has to be held.
"""

from __future__ import annotations

import functools
import gc
import re
import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import documents, map_rows, release_memory, whole_texts
from lakemart.llm.token_counts import byte_level_vocabulary, is_plain_byte_level

#: The code points with Unicode's White_Space property.
SPACES = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
#: The contractions that byte-level pre-tokenizers split off.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Encoded words of a generation; older generations are forgotten, which bounds memory and no result.
WORDS_HELD = 200_000
#: Characters of text whose words are encoded in one walk.
CHARS_PER_WALK = 3_000_000


def ranges(most: int, wanted) -> str:
    """Regular-expression ranges of the code points up to ``most`` whose category is ``wanted``."""
    out, start = [], None
    for point in range(most + 2):
        held = point <= most and not 0xD800 <= point <= 0xDFFF and wanted(unicodedata.category(chr(point)))
        if held and start is None:
            start = point
        elif not held and start is not None:
            out.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    return "".join(out)


@functools.cache
def splitter(most: int) -> tuple[re.Pattern, re.Pattern]:
    """Pattern of pre-tokens, and of code points that Python's tables do not know, up to ``most``."""
    letters = ranges(most, lambda c: c[0] == "L")
    numbers = ranges(most, lambda c: c[0] == "N")
    unknown = ranges(most, lambda c: c == "Cn")
    parts = f"{ENDINGS}| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
    return re.compile(parts), re.compile(f"[{unknown}]" if unknown else r"(?!)")


@functools.cache
def library_pieces(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str


def pieces(text: str, path: str) -> list[str]:
    """Pre-tokens of a text. Code points newer than Python's tables are left to the library."""
    if text.isascii():
        return splitter(0x7F)[0].findall(text)
    most = 0xFFFF if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else sys.maxunicode
    pattern, unknown = splitter(most)
    if unknown.search(text):
        return [text[a:b] for _, (a, b) in library_pieces(path)(text)]
    return pattern.findall(text)


class TrieEncoder:
    """Encodings of words by last-token states over a trie of them."""

    def __init__(self, path: str):
        if not is_plain_byte_level(path):
            raise ValueError(f"{path} is not a plain byte-level BPE whose ids follow its merges")
        self.path = path
        self.tokens, self.special, merges = byte_level_vocabulary(path)
        self.merged = {(self.tokens[a], self.tokens[b]): self.tokens[a + b] for a, b in merges}
        self.parts = {t: pair for pair, t in self.merged.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.apart: dict[int, bool] = {}  # by left token * 2 ** 24 + right token
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.raw_id = {t: t.to_bytes(4, "little") for t in (*self.tokens.values(), *self.special.values())}
        self.goto, self.fail, self.ends = self.automaton()

    def automaton(self) -> tuple[list[dict[int, int]], list[int], list[tuple]]:
        """Aho-Corasick states over all tokens; each has the tokens that end there, longest first."""
        goto: list[dict[int, int]] = [{}]
        ends: list[tuple] = [()]
        for raw, token in self.tokens.items():
            if self.is_reachable(token):
                state = 0
                for byte in raw:
                    if byte not in goto[state]:
                        goto[state][byte] = len(goto)
                        goto.append({})
                        ends.append(())
                    state = goto[state][byte]
                ends[state] = ((token, len(raw)),)
        fail, order = [0] * len(goto), [*goto[0].values()]
        for state in order:
            for byte, below in goto[state].items():
                back = fail[state]
                while back and byte not in goto[back]:
                    back = fail[back]
                fail[below] = goto[back].get(byte, 0)
                order.append(below)
            ends[state] += ends[fail[state]]
        return goto, fail, ends

    def is_reachable(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as that token."""
        pair = self.parts.get(token)
        return pair is None or self.keeps_apart(*pair, token) and all(map(self.is_reachable, pair))

    def keeps_apart(self, left: int, right: int, limit: int = sys.maxsize) -> bool:
        """Whether no merge below ``limit`` joins two neighbouring tokens across their border.

        Merges are undone from the latest back; at each step the two tokens at the border are
        those that stood there before the merge just undone, and a merge of them that ranks
        before it would have come first.
        """
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < limit:
                return False
            if left > right and left in self.parts:
                limit, left = left, self.parts[left][1]
            elif right in self.parts:
                limit, right = right + 1, self.parts[right][0]
            else:
                return True

    def encode_words(self, words: list[str]) -> None:
        """Adds the encodings of distinct words, as little-endian 32-bit ids, to ``held``."""
        apart, goto, fail, ends, raw_id = self.apart, self.goto, self.fail, self.ends, self.raw_id
        # By depth of the path to the current node: last token, its length, automaton state.
        last, lengths, states, before = [0], [0], [0], b""
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            depth, most = 0, min(len(raw), len(before))
            while depth < most and raw[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :], lengths[depth + 1 :], states[depth + 1 :]
            state = states[depth]
            for end in range(depth + 1, len(raw) + 1):
                byte = raw[end - 1]
                while byte not in goto[state]:
                    state = fail[state]
                state = goto[state][byte]
                for token, length in ends[state]:
                    if length == end:
                        break
                    left = last[end - length]
                    fits = apart.get(left << 24 | token)
                    if fits is None:
                        fits = apart[left << 24 | token] = self.keeps_apart(left, token)
                    if fits:
                        break
                last.append(token)
                lengths.append(length)
                states.append(state)
            before, ids, at = raw, [], len(raw)
            while at:
                ids.append(raw_id[last[at]])
                at -= lengths[at]
            ids.reverse()
            self.held[word] = b"".join(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        split = []
        for text in texts:
            parts = self.at_special.split(text) if self.at_special and any(s in text for s in self.special) else [text]
            split.append([p if i % 2 else pieces(p, self.path) for i, p in enumerate(parts)])
        if len(self.held) > WORDS_HELD:
            self.older, self.held = self.held, {}
        if len(self.apart) > 2 * WORDS_HELD:
            self.apart.clear()
        held = self.held
        fresh = {w for parts in split for p in parts[::2] for w in p if w not in held}
        held |= {w: self.older[w] for w in fresh if w in self.older}
        self.encode_words([w for w in fresh if w not in held])
        return [
            b"".join(
                self.raw_id[self.special[p]] if i % 2 else b"".join(map(held.__getitem__, p))
                for i, p in enumerate(parts)
            )
            for parts in split
        ]


@functools.cache
def token_bytes(path: str) -> dict[int, bytes]:
    """Bytes of each token, special ones included; all that decoding needs."""
    tokens, special, _ = byte_level_vocabulary(path)
    byte_level_vocabulary.cache_clear()
    return {t: b for b, t in tokens.items()} | {t: s.encode() for s, t in special.items()}


def decoded(ids: bytes, path: str) -> str:
    """Text of little-endian 32-bit ids; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(token_bytes(path).__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return raw.decode("utf-8", "replace")


@functools.cache
def encoder(path: str) -> TrieEncoder:
    built = TrieEncoder(path)
    byte_level_vocabulary.cache_clear()
    gc.collect()
    gc.freeze()  # its tables live as long as the worker; the collector need not walk them
    return built


def walks(texts: list[str]) -> list[tuple[int, int]]:
    """Ranges of ``texts`` of about CHARS_PER_WALK characters each; a longer text is one range."""
    out, start, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHARS_PER_WALK:
            out.append((start, i + 1))
            start, size = i + 1, 0
    return [*out, (start, len(texts))] if start < len(texts) else out


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) with the ids of every whole text as little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids; repeated rows each give a row; an empty table
    gives none; other columns are not read. Special strings in a text become their token.
    """

    def call(rows: list[dict]) -> list[tuple]:
        texts, out = [r["text"] for r in rows], []
        for a, b in walks(texts):
            out += encoder(tokenizer_path).encode(texts[a:b])
        return [(r["doc_id"], ids) for r, ids in zip(rows, out, strict=True)]

    rows = whole_texts(docs, id_col, text_col)
    return map_rows(rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary", call)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text) with the text of every row's ids; null ids count as none."""
    rows = encoded.select(encoded[id_col].alias("doc_id"), F.coalesce(encoded[ids_col], F.lit(b"")).alias("ids"))

    def call(batch: list[dict]) -> list[tuple]:
        return [(r["doc_id"], r["ids"], decoded(r["ids"], tokenizer_path)) for r in batch]

    return map_rows(rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, text string", call)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the rows of ``decode``."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): ``decode`` of ``encode``, in one worker of a task instead of two.

    Rows, nulls and empty tables: as there. The worker is given a clean start, as Spark may have
    used it for other steps before.
    """
    rows = whole_texts(docs, id_col, text_col)

    def factory():
        release_memory()
        encode_texts, text_of = encoder(tokenizer_path).encode, functools.partial(decoded, path=tokenizer_path)

        def call(batch: list[dict]) -> list[tuple]:
            texts, out = [r["text"] for r in batch], []
            for a, b in walks(texts):
                out += [(ids, text_of(ids)) for ids in encode_texts(texts[a:b])]
            return [(r["doc_id"], *both) for r, both in zip(batch, out, strict=True)]

        return call

    return map_rows(rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, text string", factory=factory)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; see ``encode_and_decode``."""
    return digests(encode_and_decode(docs, tokenizer_path, id_col, text_col))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodings and decodings of all documents by byte_bpe_50k.json."""
    import public_tokenizers

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


