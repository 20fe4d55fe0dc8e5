"""Phrase mining, importance resampling and token files against brute force, SQL and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from slipmatch.llm import phrases, queries, resampling, sql, token_files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", ["op11_collocations", "op12_resampling"])
def test_registered_query_against_sql(spark, duck, name):
    found = spark_rows(queries.queries()[name](spark, FOLDER))
    assert found == duck_rows(duck, sql.oracle_sql()[name]) and found[1]


def plain_collocations(rows, least, top, most_words=3):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def spoken(rng, n):
    words = ["new", "York", "city", "the", "of", "a", "été", "x-1", "CITY", "New"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! "]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n))


def collocation_rows(rng):
    rows = [(i, spoken(rng, rng.randrange(40)), rng.choice(["en", "fr", None, "und"]), "s") for i in range(120)]
    rows += [(900, None, "en"), (901, "", "en"), (902, " \t ", "de"), (903, "a a a a a", "xx"), (904, spoken(rng, 20_000), "en")]
    return rows + rows[:9] + [(None, "new york city", "en")] * 3


@pytest.mark.parametrize("every", [4, 10**9])
def test_collocations(make, monkeypatch, every):
    """Also when the sample is empty, so that everything has to come by border failures."""
    monkeypatch.setattr(phrases, "SAMPLE_EVERY", every)
    rows = collocation_rows(random.Random(4))
    docs = make(rows).withColumn("words", F.lit(1)).withColumn("phrase", F.lit("x")).withColumn("print", F.lit(2))
    for top in (2000, 7):
        found = phrases.collocations(docs, least=3, top=top).collect()
        got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found)
        assert got == plain_collocations([(r[2], r[1]) for r in rows], 3, top) and len(got) > 10
    assert phrases.collocations(make([])).count() == 0


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    n = 3_000_000_019
    found = spark.createDataFrame(
        [("en", 1, "a", n), ("en", 1, "b", n + 1), ("en", 2, "a b", n - 1)], "lang string, words int, phrase string, n long"
    )
    assert phrases.scored(found, 2).first()["score"] == 1_000_000 * (n - 1) ** 2 // (n * (n + 1))


def test_bitmaps_hold_what_was_put_in(spark):
    prints = spark.range(50_000).select(F.xxhash64("id").alias("print"))
    made = phrases.proposal(prints, 22)
    values = np.array([r["print"] for r in prints.collect()], dtype=np.int64).view(np.uint64)
    assert made.has(values).all() and not made.has(values ^ phrases.U(1 << 50)).all()
    assert phrases.bits_for(0) == phrases.LEAST_BITS and phrases.bits_for(10**12) == phrases.MOST_BITS


def plain_resampling(rows, target, orders, buckets, least_words, percent, seed):
    def grams(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + k]) for k in orders for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in runs]

    docs = [(i, *grams(t)) for i, t in rows]
    raw = Counter(b for _, _, found in docs for b in found)
    want = Counter(b for t in target for b in grams(t)[1])
    s_all, t_all = sum(raw.values()), sum(want.values())
    gain = [
        math.floor(1000 * math.log((want[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in range(buckets)
    ]
    scored = []
    for i, n, found in docs:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = percent * len(order) // 100
    rank = {id(r): k for k, r in enumerate(order[:drawn], 1)}
    return sorted(((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in scored), key=repr)


@pytest.mark.parametrize("orders", [(1, 1), (1, 3), (2, 2)])
def test_resampling(make, orders):
    rng = random.Random(8)
    rows = [(i, spoken(rng, rng.randrange(60))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, " -- "), (903, "été" * 40), (904, spoken(rng, 20_000)), (None, spoken(rng, 30)), (None, None)]
    rows += rows[:20]
    target = [spoken(rng, 50).replace("the", "york"), None, "", "York city"]
    docs = make(rows).withColumn("score", F.lit(0)).withColumn("place", F.lit(1)).withColumn("range", F.lit(1))
    for least_words, percent in ((20, 10), (0, 100), (5, 33)):
        found = resampling.resampled(docs, make([(0, t) for t in target]), *orders, buckets=97, least_words=least_words, percent=percent)
        got = sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in found.collect()), key=repr)
        assert got == plain_resampling(rows, target, range(orders[0], orders[1] + 1), 97, least_words, percent, 2024)
    assert resampling.resampled(make([]), make([(0, "x")])).count() == 0
    nothing = resampling.resampled(make([(1, "a b")]), make([]), least_words=1, percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in nothing] == [(1, 2, 1)]


def test_equal_scores_are_drawn_by_id(spark):
    scored = spark.range(1000).selectExpr("999 - id AS doc_id", "30L AS n_words", "30L AS n_features", "1L AS weight", "7L AS score")
    drawn = resampling.ranked(scored, 20, 10).where("rank IS NOT NULL").collect()
    assert {r["doc_id"]: r["rank"] for r in drawn} == {i: i + 1 for i in range(100)}


def test_overlapping_spans():
    data = resampling.collapsed("One-two,  THREE\nétoile 4")
    assert data == "one two three étoile 4".encode()
    assert [data[a:b].decode() for a, b in resampling.gram_spans(data, 2, 3)] == [
        "one two", "two three", "three étoile", "étoile 4", "one two three", "two three étoile", "three étoile 4"
    ]


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(6)
    texts = ["a  b", " a", "a ", "a\n\nb", "a \n b", "it's\nTHE 'll", "x <|endoftext|> y<|endoftext|>", " a  b", "x\0y z",
             "tab\there  now", None, "", " ", "\n", "œuvre naïve, Ünï! ß? ª º İ ı ſ. 2a; ab3", "…“q” — 。「x」　y"]
    return texts + ["".join(rng.choice("ab é.,'1\n <|>  x") for _ in range(rng.randrange(40))) for _ in range(400)]


def test_token_files(make, tokenizer, tmp_path, spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    rng = random.Random(2)
    rows = [(5 * i, t) for i, t in enumerate(odd_texts())] + [(7, "same"), (7, "same"), (7, "other"), (None, "x"), (None, None)]
    rows += [(100_000, "word " * 50_000), (100_001, spoken(rng, 3000))]
    rng.shuffle(rows)
    docs = make(rows).withColumn("ids", F.lit(1)).withColumn("record", F.lit("x")).repartition(5)
    files = token_files.TokenFiles(spark, f"file://{tmp_path}/table")
    files.write(docs, tokenizer, 2, file_bytes=4000)
    assert len(list((tmp_path / "table" / "frames").glob("part-*"))) > 3
    found = sorted(files.read().collect(), key=lambda r: r["start"])
    ids = [np.frombuffer(r["ids"], dtype="<u4").tolist() for r in found]
    expected = Counter((i, (*model.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in rows)
    assert Counter((r["doc_id"], tuple(x)) for r, x in zip(found, ids, strict=True)) == expected
    assert [r["n_tokens"] for r in found] == [len(x) for x in ids]
    assert [r["start"] for r in found] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert order == sorted(order)
    assert sorted(x.tolist() for x in files.document(7)) == sorted([*model.encode(t, add_special_tokens=False).ids, 2] for t in ("same", "same", "other"))
    assert len(files.document(100_000)[0]) == len(model.encode("word " * 50_000, add_special_tokens=False).ids) + 1
    assert files.document(-5) == []
    assert files.dictionary().content and files.index().select("dictionary").distinct().first()[0] == files.dictionary().sha256


def test_a_wrong_dictionary_is_noticed(tokenizer):
    good = token_files.Dictionary(b"", hashlib.sha256(b"").hexdigest(), 2)
    good.decompressor()
    with pytest.raises(ValueError, match="hash"):
        token_files.Dictionary(b"other", good.sha256, 2).decompressor()
    with pytest.raises(ValueError, match="end mark"):
        list(token_files.parsed(token_files.record(1, b"frame", 3) + b"x"))


def test_empty_and_tiny_token_files(make, tokenizer, tmp_path):
    empty = token_files.stored(make([]), tokenizer, 2, f"file://{tmp_path}/empty")
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids"]
    tiny = token_files.stored(make([(3, None)]), tokenizer, 2, f"file://{tmp_path}/tiny").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in tiny] == [(3, 0, 1, b"\2\0\0\0")]


def test_other_tokenizers_encode_whole_texts(make, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(odd_texts()[:80])]
    found = token_files.stored(make(rows), path, 2, f"file://{tmp_path}/words").collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in found} == {
        i: [*model.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows
    }


def test_registered_token_files_query(spark, tokenizer):
    from tokenizers import Tokenizer

    model, start = Tokenizer.from_file(tokenizer), 0
    found = {r["doc_id"]: r for r in queries.op13_token_files(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = np.array([*model.encode(doc["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        r = found[doc["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
