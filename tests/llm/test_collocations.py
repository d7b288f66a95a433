"""Phrase collocations and sharding against SQL and brute force."""

import collections
import hashlib
import random
import re

import pytest

import check
from millrace.llm import collocations, sharding

SF_DIR = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op12_phrase_collocations", "op13_sharding"])
def test_against_sql(spark, name):
    assert check.compare(spark, check.duck(SF_DIR), SF_DIR, name) == ""


def brute(rows, top, least):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                f[lang or "und"].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if " " not in p)
        frequent = {p: a for p, a in counts.items() if a >= least and " " in p}
        found = []
        for p, a in frequent.items():
            if any(b >= a and len(q) > len(p) and f" {p} " in f" {q} " for q, b in frequent.items()):
                continue
            words = p.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[" ".join(words[:k])], counts[" ".join(words[k:])]
                cuts.append((1000 * a * n // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, p.encode(), left, right, n))
        for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrases(n_docs, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(14)] + ["Ä", "zz\x0e", "x y"]
    fixed = ["alpha beta gamma delta", "one two three four five six", "so far, so good", "new york", "A\tB  c"]
    rows = []
    for i in range(n_docs):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(rnd.randint(0, 30))]
        text = "".join(p + rnd.choice([" ", " ", " ", " ", "\t", ". ", "\n"]) for p in parts)
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), text))
    return rows


@pytest.mark.parametrize(("top", "first_block", "block"), [(2000, 1 << 15, 1 << 19), (5, 9, 12)])
def test_rounds_and_blocks_do_not_change_results(spark, top, first_block, block):
    rows = phrases(120, 4) + [("en", None), ("en", ""), ("fr", " \t.\n")] + [("en", "new york " * 3000)]
    docs = spark.createDataFrame([(i, t, g, "x", 1.0) for i, (g, t) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase string, n double")
    got = collocations.collocations(docs, top, 8, first_block, block).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, top, 8)


def test_settled_before_all_is_grown(spark, monkeypatch):
    """Common words are never grown once rare ones fill the list."""
    rows = [("en", "rare pair. " * 10 + "the cat. the dog. a cat. " * 50)]
    docs = spark.createDataFrame([(0, t, g) for g, t in rows], "doc_id bigint, text string, lang string")
    grown, firsts = [], collocations._firsts
    monkeypatch.setattr(collocations, "_firsts", lambda found: grown.extend(r.phrase for r in found) or firsts(found))
    got = collocations.collocations(docs, 1, 8, 1, 1).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 1, 8) and set(grown) <= {"rare", "pair"}


def test_long_pieces_are_whole():
    data = b"a b" * 50 + b"." + b"c" * 400 + b"." + b"d"
    runs = list(collocations._chunks(data, 100))
    assert b"".join(runs) == data and all(r.endswith(b".") for r in runs[:-1])


def test_products_beyond_64_bits(spark):
    row = spark.sql("select 900000000000L f, 900000000000L l, 1000000000000L r, 8000000000000L n")
    assert row.select(collocations._score("f", "l", "r")).first()[0] == 1000 * 8 * 10**12 * 9 * 10**11 // (9 * 10**11 * 10**12)


@pytest.mark.parametrize("columns", [["doc_id", "text"], ["doc_id", "text", "lang"]])
def test_no_phrases(spark, columns):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert collocations.collocations(none).collect() == []
    assert sharding.shards(none.select(*columns), 24).collect() == []


def brute_shards(rows, n):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    keyed = sorted((md5(t or "") + md5("" if i is None else str(i)), len((t or "").encode()) + 8) for i, t in rows)
    total, below = sum(s for _, s in keyed), [0]
    for _, s in keyed:
        below.append(below[-1] + s)
    starts = [k for k in range(len(keyed) + 1) if k in (0, len(keyed)) or keyed[k][0] != keyed[k - 1][0]]
    cuts = [min(starts, key=lambda k: (abs(n * below[k] - i * total), k)) for i in range(1, n)]
    return [sum(c <= k for c in cuts) for k in range(len(keyed))], keyed


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_by_brute_force(spark, n):
    rnd = random.Random(n)
    rows = [(i, "copy " * 9 if rnd.random() < 0.4 else "x" * rnd.randint(0, 400)) for i in range(300)]
    rows += [(None, None), (300, ""), (301, "é" * 5000), (302, None)]
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id bigint, text string, shard int, key string")
    for piece in (1 << 28, 64):  # one and many pieces to a shard
        got = sharding.shards(docs, n, piece_bytes=piece).collect()
        want, keyed = brute_shards(rows, n)
        assert sorted((r.shard, r.size) for r in got) == sorted((s, size) for s, (_, size) in zip(want, keyed))
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(own) == list(range(len(own))) for own in slots.values())
        assert got[0].asDict().keys() == {"doc_id", "text", "key", "size", "shard", "slot"}


def test_a_hot_repeated_row_is_cut(spark):
    rows = [(None, "the same row")] * 400 + [(i, f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.shards(docs, 6).collect()
    bytes_ = collections.Counter()
    for r in got:
        bytes_[r.shard] += r.size
    assert len(got) == 600 and max(bytes_.values()) - min(bytes_.values()) <= 40


def test_tolerance_stops_early(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)], "doc_id bigint, text string")
    bytes_ = collections.Counter()
    for r in sharding.shards(docs, 4, tolerance=0.05).collect():
        bytes_[r.shard] += r.size
    assert max(bytes_.values()) - min(bytes_.values()) <= 0.1 * sum(bytes_.values()) / 4
