"""Quality rules by weak supervision.

Each rule votes to keep or to reject a document, or abstains. Expectation-maximisation over the
counts of vote patterns estimates how often each rule votes how on good and on bad documents;
the posterior probability of quality of a document's pattern takes the place of a filter in
which every rule has to pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import documents, map_rows, stored, whole_texts

LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
#: Documents with a posterior below this are rejected.
LEAST_POSTERIOR = 0.5

ABSTAIN, REJECT, KEEP = 0, 1, 2
#: Rules: name, what is measured, reject from (or below) a value, keep below (or from) a value.
#: Between the two values, and where the measure is not defined, a rule abstains.
RULES = (
    ("words", "n_words", "below", 20, 50),
    ("word_length", "mean_word", "below", 2.0, 3.0),
    ("long_words", "mean_word", "above", 14.0, 10.0),
    ("symbols", "symbols_per_word", "above", 0.2, 0.05),
    ("duplicate_lines", "duplicate_line_share", "above", 0.5, 0.05),
    ("repetition", "repeat_share", "above", 0.3, 0.1),
    ("capitals", "capital_share", "above", 0.4, 0.1),
    ("sentence_ends", "ended_line_share", "below", 0.1, 0.5),
)
#: Least share of right votes on good documents. One half keeps the classes from changing places. A
#: rule's habit on good documents and a fault that it alone sees look alike in votes; for symbols the
#: labels decide it: none of 286 labelled documents of sf0.1 that this rule alone rejects is good.
LEAST_RIGHT = {"symbols": 0.998}
GOOD_LEAST = np.array([LEAST_RIGHT.get(r[0], 0.5) for r in RULES])
MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_capital_words bigint, n_ended_lines bigint"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that the text holds twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    # Equal windows share this hash; windows that share it are compared in full.
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + n]
        hashes ^= hashes >> np.uint64(31)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][equal]] = True
    maybe[order[:-1][equal]] = True
    at = np.flatnonzero(maybe)
    full = ids[at[:, None] + np.arange(window)]
    _, group, size = np.unique(full, axis=0, return_inverse=True, return_counts=True)
    starts = at[size[group.ravel()] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The numbers of ``MEASURES`` for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(raw.count(bytes([c])) for c in SPACES),
        sum(raw.count(bytes([c])) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(w.isupper() and len(w) > 1 for w in words),
        sum(line.rstrip(b" \t\r\x0b\x0c\"')")[-1:] in (b".", b"!", b"?") for line in lines),
    )


def votes() -> list:
    """One column for each rule."""
    col = F.col
    some = col("n_words") > 0
    measured = {
        "n_words": col("n_words").cast("double"),
        "mean_word": F.when(some, col("word_chars") / col("n_words")),
        "symbols_per_word": F.when(some, col("n_symbols") / col("n_words")),
        "duplicate_line_share": F.when(col("n_lines") > 3, col("n_dup_lines") / col("n_lines")),
        "repeat_share": F.when(col("n_words") >= 2 * WINDOW, col("n_repeat_words") / col("n_words")),
        "capital_share": F.when(some, col("n_capital_words") / col("n_words")),
        "ended_line_share": F.when(col("n_lines") > 0, col("n_ended_lines") / col("n_lines")),
    }
    out = []
    for name, what, side, reject, keep in RULES:
        x = measured[what]
        bad, good = (x < reject, x >= keep) if side == "below" else (x >= reject, x < keep)
        out.append(F.when(bad, REJECT).when(good, KEEP).otherwise(ABSTAIN).alias(f"vote_{name}"))
    return out


def fit(
    patterns: np.ndarray, counts: np.ndarray, good_least=0.998, bad_least=0.25, rounds: int = 200,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good documents, P(right vote | class) by rule, and the posterior of each pattern.

    ``patterns`` has a row for each distinct pattern. A rule looks at one kind of fault, so a bad
    document may well be kept by most rules, yet by not more than three in four. The bounds
    ``bad_least`` and ``good_least`` (one for all rules or one each) say how far a rule is trusted
    beforehand: with the defaults, for rules that hardly ever reject a good document, a fault that
    one rule sees is a fault; bounds of 0.5 let the votes tell how often a rule rejects good
    documents and only keep the two classes from changing places. A rule that abstains says nothing.
    """
    rules = patterns.shape[1]
    least = np.stack([np.broadcast_to(x, rules) for x in (bad_least, good_least)]).astype(float)
    right = np.maximum(least, [[0.4], [0.998]])  # rows: bad documents that get a vote, good ones
    share = 0.9
    reject, keep = patterns == REJECT, patterns == KEEP
    posterior = np.full(len(patterns), share)
    for _ in range(rounds):
        good = np.log(share) + keep @ np.log(right[1]) + reject @ np.log(1 - right[1])
        bad = np.log(1 - share) + reject @ np.log(right[0]) + keep @ np.log(1 - right[0])
        posterior = 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))
        weight = counts * posterior, counts * (1 - posterior)
        share = float(np.clip(weight[0].sum() / max(counts.sum(), 1), 0.5, 0.99))
        right[1] = np.clip((weight[0] @ keep + 99) / (weight[0] @ (keep | reject) + 100), least[1], 0.99995)
        right[0] = np.clip((weight[1] @ reject + 1) / (weight[1] @ (keep | reject) + 5), least[0], 0.95)
    return share, right, posterior


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measures, votes, base_failed, posterior, kept) of every row.

    A null text counts as one without words; repeated rows each give a row and each count in the
    estimates; an empty table gives no rows; other columns are not read. What comes to the driver
    is a count for each vote pattern, at most three to the power of the number of rules.
    """
    rows = whole_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = map_rows(rows, f"doc_id {kind}, {MEASURES}", lambda batch: [(r["doc_id"], *measure(r["text"])) for r in batch])
    names = [f"vote_{r[0]}" for r in RULES]
    voted = stored(measured.select("*", *votes()), "votes")
    spark = docs.sparkSession
    seen = voted.groupBy(*names).count().collect()
    patterns = np.array([r[:-1] for r in seen], np.int64).reshape(len(seen), len(RULES))
    *_, posterior = fit(patterns, np.array([r["count"] for r in seen], float), GOOD_LEAST)
    table = spark.createDataFrame(
        [(*map(int, p), float(x)) for p, x in zip(patterns, posterior, strict=True)],
        ", ".join(f"{n} int" for n in names) + ", posterior double",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        voted.join(F.broadcast(table), names)  # at most 3 ** len(RULES) rows
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= LEAST_POSTERIOR))
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )
