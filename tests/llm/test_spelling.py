"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lakemart.llm import oracles, spelling

SCHEMA = "doc_id bigint, text string, word string, n int, key string, rest string, form string"


def near(a, b):
    """Whether one inserted, deleted or replaced code point turns one into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows, least_count=5, least_length=6, modulus=199):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= least_length and c >= least_count}
    form, n_near = {}, {}
    for word in n:
        others = sorted((o for o in n if near(word, o)), key=lambda o: (-n[o], o))
        n_near[word] = len(others)
        form[word] = others[0] if others and n[others[0]] >= 5 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n[word], n_near[word], n.get(form[word])))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, "k", "r", "f") for r in rows], SCHEMA)


def found(spark, rows, **how):
    return sorted(tuple(r) for r in spelling.spelling_variants(frame(spark, rows), **how).collect())


def texts(seed, stems, letters, documents, often):
    """Texts of words, their misspellings and the misspellings of those, ever rarer."""
    rng = random.Random(seed)
    words = []
    for _ in range(stems):
        word = "".join(rng.choices(letters, k=rng.randint(5, 9)))
        weight = often
        for _ in range(4):
            words += [word] * weight
            i = rng.randrange(len(word))
            word = rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])
            weight = max(1, weight // rng.choice([3, 6]))
    rng.shuffle(words)
    size = len(words) // documents
    return [(i, " ".join(words[i * size : (i + 1) * size])) for i in range(documents)]


@pytest.fixture(scope="module")
def rows():
    made = texts(1, 60, "abcéß", 40, 200)
    made += [(None, "Spelling SPELLING spelling speling " * 6), (100, None), (101, ""), (102, "short runs on-ly\n1234567 ÄÖÜäöüß×÷ ÄÖÜäöüß×÷")]
    made += [(103, "z" * 30_000)] * 5 + [(103, "z" * 29_999)] * 5  # a word is no shorter for being long
    made += [(200 + i, "aaaaaa aaaaaaa aaaaaaaa aaabaaa ") for i in range(30)]
    return made


def test_forms_follow_a_comparison_of_all_words(spark, rows):
    want = brute_force(rows)
    assert any(r[1] and r[1] != r[2] for r in want)  # forms of forms
    assert found(spark, rows) == want


def test_deletions_are_drawn_by_crc(spark, rows):
    assert found(spark, rows, delete_modulus=3) == brute_force(rows, modulus=3)


def test_hot_chunks_are_cut_again(spark):
    made = texts(2, 80, "ab", 10, 40)
    want = brute_force(made)
    assert max(r[4] for r in want) > 5
    for bound in (200, 1):
        assert found(spark, made, pairs_of_key=bound) == want


def test_no_words(spark):
    assert found(spark, []) == [] and found(spark, [(1, "few short words"), (None, None)]) == []


def test_sql_gives_the_same(spark):
    import duckdb

    made = texts(3, 60, "abcdeé", 20, 100)
    db = duckdb.connect()
    db.register("documents", frame(spark, made).toPandas())
    assert sorted(db.execute(oracles.spelling_variants()).fetchall()) == sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in found(spark, made))
