import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm.collocations import Filter, collocation_query, collocations, filter_of, pair_hashes, segments, word_hashes, word_ids
from tests.llm import cases

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least=100, longest=5, absorbed=100, most=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, words[k : k + size]) for k in range(len(words) - size + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), f in candidates.items():
        for k in range(len(words)):
            for end in range(k + 2, len(words) + 1):
                inner = (lang, words[k:end])
                if len(inner[1]) < len(words) and 100 * f >= absorbed * counts[inner]:
                    gone.add(inner)
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in gone:
            n = totals[lang]
            cuts = [(1000 * a * n // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            row = (" ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], n, score)
            found.setdefault(lang, []).append(row)
    out = []
    for lang, own in found.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, rank, *r) for rank, r in enumerate(own[:most], 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, collocation_query(docs, **options).collect()))


def pairs(docs):
    return [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]


def test_whole_table(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    want = brute(pairs(docs))
    assert want
    assert found(docs) == want


@pytest.mark.parametrize("seed", range(3))
def test_small_ranges_and_chunks(spark, seed):
    rng = random.Random(seed)
    text = lambda: " ".join(rng.choice("a b b c the The é . , x\t y\n z!".split(" ")) for _ in range(rng.randrange(60)))
    rows = [(rng.choice(["en", "de", None]), text()) for _ in range(120)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for options in [{"least": 3}, {"least": 5, "absorbed": 60}, {"least": 2, "longest": 3}][seed : seed + 1]:
        assert found(docs, rows_per_range=11, chunk_bytes=300, **options) == brute(rows, **options)


def test_a_phrase_inside_a_longer_one_goes(spark):
    rows = [("en", "new york city hall")] * 5 + [("en", "york city")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    phrases = {r["phrase"]: r["a"] for r in collocations(docs, least=5).collect()}
    assert phrases == {"york city": 6, "new york city hall": 5}


def test_overlaps_count_and_products_pass_64_bits(spark):
    rows = [("en", "a a a a a")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found(docs, least=2) == brute(rows, least=2)
    cut = "(1000 * (cast({0} AS DECIMAL(19,0)) * cast({0} AS DECIMAL(19,0)))) div (cast({1} AS DECIMAL(19,0)) * cast({1} AS DECIMAL(19,0)))"
    big, small = 10**15 + 37, 10**14 + 7
    assert spark.sql(f"SELECT {cut.format(f'{big}L', f'{small}L')} AS s").first()["s"] == 1000 * big * big // (small * small)


def test_most_are_ranked_with_ties(spark):
    rows = [("en", f"w{k} v{k}") for k in range(40) for _ in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    from fraudlake.llm.collocations import top

    got = sorted(map(tuple, top(collocations(docs, least=3), 7).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == brute(rows, least=3, most=7)


def test_filter_has_no_false_negative_and_stays_small(spark):
    hashes = pair_hashes(word_hashes("en", [b"w%d" % k for k in range(3000)]), word_hashes("en", [b"v%d" % (k % 7) for k in range(3000)]))
    held = spark.createDataFrame([(h,) for h in hashes.view(np.int64).tolist()], "h long")
    for most in (1 << 12, 1 << 27):
        known = filter_of(held, most)
        assert known.bits.nbytes * 8 <= max(most, 1 << 12)
        assert known.has(hashes).all()
    assert known.has(word_hashes("en", [b"other%d" % k for k in range(3000)])).mean() < 0.1
    assert not Filter(np.zeros(64, dtype=np.uint64)).has(word_hashes("en", [b"x"])).any()


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(Filter, "has", lambda self, hashes: np.ones(len(hashes), dtype=bool))
    assert found(docs, least=200) == brute(pairs(docs), least=200)


def test_segments_keep_pieces_and_words():
    text = ("Ab cd. ef,gh\ti " * 50 + "long" * 30 + " x; y").encode()
    joined = b"".join(segments(text, 40))
    assert joined == b"".join(segments(text))
    words, ids = word_ids(joined)
    assert [words[i].decode() if i >= 0 else "|" for i in ids[:8]] == ["ab", "cd", "|", "ef", "|", "gh", "i", "ab"]


def test_odd_rows_and_empty_table(spark):
    docs = cases.documents(spark)
    assert found(docs, least=2) == brute([(r[2], r[1]) for r in cases.ROWS], least=2)
    clashing = docs.withColumns({c: F.lit("other") for c in ("words", "f", "n", "phrase", "back", "lefts", "rights", "whole", "_range", "a")})
    assert found(clashing, least=2) == found(docs, least=2)
    assert collocation_query(cases.empty(spark)).collect() == []
    assert found(spark.createDataFrame([("en", None), ("en", " \t.")], "lang string, text string"), least=1) == []
