"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, connect
from paneloom.llm import collocations as co
from paneloom.llm import queries
from paneloom.lookup import lookup_table

DOCS = "doc_id long, text string, lang string, source string, words int, phrase string, a long"


def brute(rows, support, top):
    """rows: (text, lang)."""
    words, counts = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    counts[lang, tuple(w[i : i + n])] += 1
    often = {k: v for k, v in counts.items() if v >= support}
    out = []
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = often[lang, p[:k]], often[lang, p[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        longer = (
            (q, f)
            for (other, q), f in often.items()
            if other == lang and len(q) > len(p) and 100 * f >= 80 * a
        )
        if any(q[i : i + len(p)] == p for q, _ in longer for i in range(len(q) - len(p) + 1)):
            continue
        out.append((lang, " ".join(p), a, left, right, words[lang], score))
    got, rank = [], Counter()
    for row in sorted(out, key=lambda r: (r[0], -r[6], -r[2], r[1].encode())):
        rank[row[0]] += 1
        if rank[row[0]] <= top:
            got.append((row[0], rank[row[0]], *row[1:]))
    return sorted(got)


def documents(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Zoë", "ÉA", "naïve", " x", "--"]
    fixed = ["new york city hall", "carpe diem", "a b a b a b", "to be or not to be"]
    rows = []
    for i in range(300):
        words = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(30)]
        joins = [rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]) for _ in words]
        text = "".join(w + j for w, j in zip(words, joins))
        rows.append((text.upper() if i % 9 == 0 else text, rng.choice(["en", "en", "de", None])))
    rows += [(None, "en"), ("", "fr"), (" \t.,", "fr"), (None, None), ("one", "xx"), ("the same line " * 4000, "en")]
    return rows + rows[:40]


def frame(spark, rows):
    return lookup_table(
        spark, [(i, t, l, "s", 1, "clash", 7) for i, (t, l) in enumerate(rows)], DOCS
    )


@pytest.mark.parametrize("support, shard_words", [(30, 200), (30, 4000), (30, 1 << 18), (3, 500), (1, 7000)])
def test_against_all_phrases(spark, support, shard_words):
    rows = documents()
    got = co.collocations(frame(spark, rows).repartition(3), support, 50, shard_words)
    assert sorted(map(tuple, got.collect())) == brute(rows, support, 50)


@pytest.mark.parametrize("chunk", [1, 7, 300, 1 << 22])
def test_tokens_against_a_split(monkeypatch, chunk):
    """Words are found in whole runs of texts, without an object for each; texts don't run together."""
    monkeypatch.setattr(co, "CHUNK_BYTES", chunk)
    texts = ["skipped", "", "Ab cd", "ef", ".", "", "x.,Y", " \t", "naïve É\u2003Z \x1f!", "end", "", *(t or "" for t, _ in documents()[:30])]
    want, got = [], []
    for text in texts[1:]:
        marked = re.sub("[.,;:!?\x0a-\x0d]", " . ", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        want.append(re.findall("[^\x20\x09]+", marked))
    for tokens in co.tokens_of(pa.array(texts)[1:]):
        words = iter(tokens.words.to_pylist())
        found = [next(words).decode() if w else "." for w in tokens.is_word]
        got += [found[a:b] for a, b in zip(tokens.first, tokens.first[1:])]
        assert next(words, None) is None
    assert got == want
    assert not list(co.tokens_of(pa.array([], pa.string())))


def test_a_shard_keeps_each_word_once(spark):
    batch = pa.record_batch([pa.array(["the same line. " * 4000]), pa.array(["en"])], ["text", "lang"])
    (parts,) = co.shards(iter([batch]), 1 << 18)
    assert len(parts["en"]) == 12_000 and len(parts["en"].words) == 3
    texts, counts = parts["en"].exact(np.arange(0, 8, 4), 2)
    assert dict(zip(texts.to_pylist(), counts.tolist())) == {b"the same": 2}
    plan = co.word_counts(frame(spark, documents()))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan


def test_local_support_is_proportional():
    assert co.local_support(30, 100, 1000) == 3
    assert co.local_support(30, 101, 1000) == 4
    assert co.local_support(30, 1, 1000) == 1
    assert co.local_support(30, 5, None) == 1


def test_languages_of_unknown_size(spark, monkeypatch):
    rows = documents(5)
    monkeypatch.setattr(co, "LANGS", 1)
    got = co.collocations(frame(spark, rows), 20, 30, 3000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 30)


def test_full_bitmap_only_costs_time(spark, monkeypatch):
    rows = documents(6)
    monkeypatch.setattr(co, "LEAST_BITS", 64)
    monkeypatch.setattr(co, "MOST_BITS", 64)
    got = co.collocations(frame(spark, rows), 25, 30, 2000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 25, 30)


def test_long_pieces_are_cut_with_overlap(spark):
    rows = [("x y z u v " * 500, "en"), ("x y z u v", "en")]
    got = co.collocations(frame(spark, rows), 30, 100, 64)
    assert sorted(map(tuple, got.collect())) == brute(rows, 30, 100)


def test_no_words(spark):
    assert co.collocations(frame(spark, []).where("false")).count() == 0
    assert co.collocations(frame(spark, [(None, None), ("", "en"), ("...", None)])).count() == 0


def test_numbers_past_64_bits(spark):
    big = 4 * 10**18
    rows = [("en", 1, "p", big), ("en", 1, "q", big), ("en", 2, "p q", big - 1), ("en", 3, "p q r", 3 * 10**18)]
    rows += [("en", 1, "r", big), ("en", 2, "q r", 3 * 10**18)]
    frequent = lookup_table(spark, rows, "lang string, words int, phrase string, a long")
    got = {r["phrase"]: r for r in co.scored(frequent).collect()}
    assert got["p q"]["score"] == 2_000_000 * (big - 1) // (2 * big)
    kept = {r["phrase"] for r in co.not_covered(co.scored(frequent), frequent).collect()}
    assert kept == {"p q", "p q r"}  # 3 of 4 is under 80 %; "q r" lies wholly in the longer one


def test_query_against_sql(spark, sf_dir):
    notes = compare(queries.phrases(spark, sf_dir), connect(sf_dir), queries.PHRASES_SQL)
    assert not notes, "\n".join(notes)
