"""The text operators against brute force, exact round trips and held-out accuracy, on small fixtures."""

import hashlib
import heapq
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
from millrace.llm import decontaminate, langid, pieces, pii, simhash, substrings, token_file, toxicity, winnow
from millrace.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, hash string, fp string, nth string, bucket string"
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a b c"), (5, "a b c"), (5, "a b c"), (6, "x " * 3000), (None, "a b c"),
    (7, "one two three four five six seven eight nine ten " * 5), (8, "é" * 500 + " \U0001f600 ok"), (9, "ONE two three"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, "h", "f", "n", "b") for i, t in ODD], COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def run(spark, name):
    return {r.doc_id: r for r in entry.queries()[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op5_benchmark_decontamination"])
def test_against_sql(spark, name):
    assert check.compare(spark, check.duck(SF_DIR), SF_DIR, name) == ""


def test_decontamination_beyond_the_literal_bound(spark, docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    few, many, more = (
        decontaminate.contamination(docs, items, max_literals=n, max_broadcast=m).orderBy("doc_id").collect() for n, m in ((50_000, 0), (0, 1 << 20), (0, 0))
    )
    assert few == many == more and any(r.contaminated for r in few)


def brute_groups(prints, bits):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= bits:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("blocks, seed", [(3, 3), (3, 5), (2, 4)])
def test_ball_links_on_crowded_fingerprints(spark, blocks, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 62, 4).tolist()
    prints = set()
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False).tolist()
            prints.add(c ^ sum(1 << f for f in flips))
        low = rng.choice(20, 3, replace=False).tolist()  # all differing bits in one block
        prints.add(c ^ sum(1 << f for f in low))
    want = brute_groups(sorted(prints), 3)
    signed = lambda p: p - (1 << 64) if p >= 1 << 63 else p
    links = simhash.ball_links(spark.createDataFrame([(signed(p),) for p in prints], "fp bigint"), blocks=blocks)
    found = {r.node % (1 << 64): r.component % (1 << 64) for r in components(links).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(found.get(p, p), set()).add(p)
    expected = {}
    for p, root in want.items():
        expected.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_simhash_query(spark, texts):
    got, prints = run(spark, "op7_simhash_near_dedup"), {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    roots = brute_groups(sorted(set(prints.values())), 3)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()}


def test_pii_against_patterns(spark, texts):
    got = run(spark, "op6_pii")
    digits = lambda s: re.sub("[^0-9]", "", s)
    extra = {-1: "a@b.c@d.e x@y 1.2.3.4.5.6.7.8 256.1.1.1 1..2.3.4.5 +1 (499) 555-6503 4111 1111 1111 1111 +12 a.b+c@d-e.fg.h,"}
    for i, text in {**texts, **extra}.items():
        found = pii.find(text)
        want = {
            "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
            "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))],
            "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))],
            "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15],
        }
        assert {k: found[k] for k in pii.BASE} == want
        if i in got:
            assert got[i].base_sha256 == hashlib.sha256(pii.listed(found, pii.BASE).encode()).hexdigest()
    assert pii.masked("mail a@b.cd now", pii.find("mail a@b.cd now")) == "mail [EMAIL] now"


def test_pieces_query(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = run(spark, "op10_sentencepiece")
    for i, text in texts.items():
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_token_file_query(spark, texts):
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = run(spark, "op9_token_ids")
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_word_encoder_on_odd_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = token_file.WordEncoder(path), Tokenizer.from_file(path)
    assert encoder.direct
    for text in ("Don't STOP, it's 42. é, é. İstanbul ΣΑΣ ſ ß ... a.b,c <|endoftext|>. x\x1cy  z", "", " \n", "日本語. ١٢ 🙂,"):
        assert np.frombuffer(encoder.encode([text.encode()])[0], dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_asks_the_model_once_per_form():
    encoder = token_file.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    asked, by_model = [], encoder._by_model
    encoder._by_model = lambda form: asked.append(form) or by_model(form)
    first, second = encoder.encode([b"Zebrafish ZEBRAFISH, zebrafish."]), encoder.encode([b"zebraFish?! (zebrafish zebrafish;"])
    assert asked == ["zebrafish"] and len(first) == len(second) == 1


def test_word_encoder_in_pieces(monkeypatch):
    """Texts, among them long ones and long gaps, in calls of many pieces, against the library."""
    monkeypatch.setattr(token_file, "PIECE_BYTES", 64)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(4)
    encoder, tokenizer = token_file.WordEncoder(path), Tokenizer.from_file(path)
    parts = [*"abzAZ\u00c9\u00e7\u00df\u0178\u0130\u01c5\u00d7\u00f7\u00aa\u00ba\u024f\u0250\u03a3\u65e5\u0301\u2026!.,;'\"<|-_09 \t\n\r\x0b\x0c\x1c\xa0", " ", " ", "<|endoftext|>", "'s", "The"]
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 5, 30, 300]))) for _ in range(2000)]
    texts += [None, "", " " * 500, "x" * 500 + ".", "", "End." + " " * 300 + "\u00c9t\u00e9,", None]
    got = [ids[a:b].tolist() for ids, ends in encoder.encode_pieces(pa.array(texts, pa.string())) for a, b in itertools.pairwise(ends.tolist())]
    assert got == [e.ids for e in tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert list(encoder.encode_pieces(pa.array([], pa.string()))) == []


def test_huffman_blocks():
    rng = np.random.default_rng(1)
    for ids in (rng.zipf(1.3, 5000) % 700, np.zeros(130, dtype=np.int64), np.array([5]), np.arange(300)):
        used, counts = np.unique(ids, return_counts=True)
        lengths = token_file.limited_lengths(counts, 10)
        assert lengths.max() <= 10 and (0.5**lengths).sum() <= 1
        book = token_file.Codebook(used, lengths, 10)
        bits, offsets = token_file.pack_bits(ids.astype(np.int64), *book.by_id())
        assert token_file.unpack_bits(bits, offsets, len(ids), *book.table(), 10).tolist() == ids.tolist()


def plain_mix(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def plain_winnow(text, gram=20, window=100):
    """(hash, position) of the least gram of each window, the rightmost of equals; one Python number at a time."""
    points = [plain_mix(ord(c) + 1) for c in text]
    gram, base = min(gram, len(points)), 0x9E3779B97F4A7C15
    powers = [pow(base, j, 2**64) for j in range(gram)]
    grams = [plain_mix(sum(p * q for p, q in zip(points[i : i + gram], powers)) % 2**64) >> 32 for i in range(len(points) - gram + 1)] if points else []
    width, kept = min(window, len(grams)), []
    for i in range(len(grams) - width + 1 if grams else 0):
        least = min(grams[i : i + width])
        at = max(j for j in range(i, i + width) if grams[j] == least)
        if not kept or kept[-1] != (least, at):
            kept.append((least, at))
    return kept


def plain_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query(spark, texts):
    got, order = run(spark, "op8_document_fingerprints"), sorted(texts, reverse=True)
    prints = {i: plain_winnow(t) for i, t in texts.items()}
    written = lambda kept: "".join(f"{h:08x}{at:08x}" for h, at in kept)
    for i, after in zip(order, order[1:] + order[:1]):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = prints[i], plain_winnow(edited)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (written(own), written(other))
        assert (got[i].near_edited, got[i].near_next) == (plain_likeness(own, other), plain_likeness(own, prints[after]))


def test_winnow_takes_the_rightmost_of_equals():
    hashes, positions = winnow.winnow(winnow.code_points("a" * 30), gram=5, window=4)
    assert positions.tolist() == list(range(3, 26)) and len(set(hashes.tolist())) == 1


def test_language_and_toxicity(spark, docs):
    langs = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in run(spark, "op2_language_id").values() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    scores = run(spark, "op3_toxicity")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.THRESHOLD) for r in scores.values())


def counted(rows):
    return sorted(rows, key=repr)


def removed(rows, width):
    """``(doc_id, n_words, n_removed)``: a window goes that starts earlier too; rows of one id are not earlier than each other."""
    cut = [(-1 if i is None else i, k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (i, t) in enumerate(rows)]
    first = {}
    for i, _, words in cut:
        for j in range(len(words) - width + 1):
            window = tuple(words[j : j + width])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, k, words in cut:
        gone, seen = set(), set()
        for j in range(len(words) - width + 1):
            window = tuple(words[j : j + width])
            if first[window] < i or window in seen:
                gone |= set(range(j, j + width))
            seen.add(window)
        out.append((rows[k][0], len(words), len(gone)))
    return out


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, odd, empty):
    rows = odd.limit(0) if empty else odd
    told = [] if empty else ODD
    n = len(told)
    items = spark.createDataFrame([(1, "a b c"), (None, "x x"), (2, None), (3, "")], "item_id bigint, text string")
    got = substrings.remove_repeats(rows).collect()
    assert counted((r.doc_id, r.n_words, r.n_removed) for r in got) == counted(removed(told, 20))
    hits = decontaminate.contamination(rows, items).collect()
    assert counted((r.doc_id, r.n_hit) for r in hits if r.contaminated) == counted((i, 3) for i, t in told if t == "a b c")
    groups = simhash.near_groups(rows).collect()
    assert len(groups) == n and {r.component_id for r in groups if r.fp == 0} <= {1}
    assert counted((r.doc_id, r.spans) for r in pii.personal_data(rows).collect()) == counted((i, "") for i, _ in told)
    assert pii.mask_personal_data(rows).columns == rows.columns
    got = winnow.fingerprints(rows).collect()
    assert counted((r.doc_id, r.n_chars) for r in got) == counted((i, len(t or "")) for i, t in told)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_of_models_and_tokens(spark, odd, empty, tmp_path):
    rows = odd.limit(0) if empty else odd
    told = [] if empty else ODD
    nothing = langid.LanguageModel(rows).predict(rows).collect()  # no row has a language
    assert counted((r.doc_id, r.lang_pred, r.score) for r in nothing) == counted((i, "und", 0.0) for i, _ in told)
    taught = langid.LanguageModel(odd.withColumn("lang", F.lit("en"))).predict(rows).collect()
    assert counted((r.doc_id, r.lang_pred) for r in taught) == counted((i, "en" if any(map(str.isalpha, t or "")) else "und") for i, t in told)
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, 0), (77, 1), (None, 1)], "doc_id bigint, toxic int")
    scores = toxicity.ToxicityModel(rows, labels).score(rows).collect()
    assert counted(r.doc_id for r in scores) == counted(i for i, _ in told) and all(0 <= r.score <= 1 for r in scores)
    alone = toxicity.ToxicityModel(rows, labels.where("doc_id = 77")).score(rows).collect()
    assert {r.score for r in alone} <= {0.5}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = pieces.encode_and_decode(rows, public_tokenizers.path("piece_bpe_32k.model")).collect()
    want = [(i, sp.encode(t or "", add_bos=True, add_eos=True)) for i, t in told]
    assert counted((r.doc_id, np.frombuffer(r.ids, dtype="<u4").tolist(), r.decoded) for r in got) == counted((i, ids, sp.decode(ids)) for i, ids in want)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, folder = Tokenizer.from_file(path), str(tmp_path / "tokens")
    token_file.write_tokens(rows, path, folder)
    got = token_file.read_tokens(spark, folder).collect()
    want = counted((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in told)
    assert counted((r.doc_id, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in got) == want
    assert sorted(r.start for r in got) == (np.cumsum([0] + [r.n_tokens for r in sorted(got, key=lambda r: r.start)])[:-1].tolist() if got else [])


def test_pieces_equal_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path), random.Random(3)
    parts = [*"ab e.\n\t \u2581\u00e91\u65e5\U0001f642,", "the ", "  ", "ing", "<s>", "\ufb01", "\u200b"]
    texts = ["a ", " \t\n ", "x " * 3000, "", " ", "\u2581", "a\u2581b", "\x00", "word" * 400]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) + rng.choice(["", " ", "  "]) for _ in range(20_000)]
    for at in range(0, len(texts), 4000):
        some = texts[at : at + 4000]
        for text, ids in zip(some, own.encode(some)):
            assert ids.tolist() == sp.encode(text, add_bos=True, add_eos=True), repr(text)
    assert None not in own.known.values()


def test_texts_with_doubtful_segments_take_the_library_s_ids(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path)
    monkeypatch.setattr(own.table, "merged", lambda segments: {s: b"\0\0\0\0" for s in segments if "wrong" in s})
    texts = ["all is right", "this is wrong here", "wrong "]
    for _ in range(2):
        assert [i.tolist() for i in own.encode(texts)] == [sp.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_whole_texts_where_white_space_joins(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = token_file.WordEncoder(path), Tokenizer.from_file(path)
    assert encoder.apart
    monkeypatch.setattr(encoder, "apart", False)
    texts = ["Some words, two  spaces\n", ""]
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in encoder.encode([t.encode() for t in texts])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_each_group_keeps_one_row(spark):
    near = "one two three four five six seven eight nine ten eleven twelve " * 20
    rows = [(5, near), (5, "quite another text " * 9), (6, near), (6, near), (None, near), (None, "alone " * 30), (None, "alone " * 30), (7, None), (8, ""), (9, "third text here " * 8)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, row bigint").repartition(3)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    got = counted((r.doc_id, r.text) for r in kept.collect())
    assert got == counted([(5, near), (5, "quite another text " * 9), (None, "alone " * 30), (7, None), (9, "third text here " * 8)])
    assert simhash.keep_one_per_group(docs.limit(0)).collect() == []


@pytest.mark.parametrize("literals", [50_000, 0])
def test_only_rows_with_a_passage_go(spark, literals):
    items = spark.createDataFrame([(1, "the passage of the test")], "item_id bigint, text string")
    rows = [(None, "here is the passage of the test"), (None, "clean"), (4, "The PASSAGE of the test."), (4, "clean too"), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, row bigint")
    kept = decontaminate.remove_contaminated(docs, items, max_literals=literals)
    assert kept.columns == docs.columns and sorted(r.row for r in kept.collect()) == [1, 3, 4, 5]
    assert decontaminate.remove_contaminated(docs.limit(0), items).collect() == []
    assert decontaminate.remove_contaminated(docs, items.limit(0), max_literals=literals).count() == 6


def test_language_stage_uses_its_prediction(spark, docs):
    model = langid.LanguageModel(langid.learnable(docs))
    found = {r.doc_id: r for r in model.predict(docs).collect()}
    kept = {r.doc_id for r in langid.keep_identified(docs, model, ["de", "fr"], 0.9).collect()}
    assert kept == {i for i, r in found.items() if r.lang_pred in ("de", "fr") and r.score >= 0.9} and kept
    assert langid.keep_identified(docs.limit(0), model).collect() == []


def test_toxic_texts_held_out(spark):
    larger = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    held = [r for r in entry.queries()["op3_toxicity"](spark, larger).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_log_count_ratios_and_ftrl_are_the_plain_ones():
    rng = np.random.default_rng(0)
    model, size = langid.Ftrl(5, 2), 5
    z, n = np.zeros((size, 2)), np.zeros((size, 2))
    for _ in range(200):
        cells, label = np.sort(rng.choice(size, 3, replace=False)), int(rng.integers(2))
        values = rng.random(3)
        model.step(cells, values, label)
        w = {c: [0.0 if abs(z[c, k]) <= langid.L1 else -(z[c, k] - np.sign(z[c, k]) * langid.L1) / ((langid.BETA + n[c, k] ** 0.5) / langid.ALPHA + langid.L2) for k in (0, 1)] for c in cells}
        logits = [sum(w[c][k] * v for c, v in zip(cells, values)) for k in (0, 1)]
        p = np.exp(logits) / np.exp(logits).sum()
        for c, v in zip(cells, values):
            for k in (0, 1):
                g = (p[k] - (k == label)) * v
                z[c, k] += g - ((n[c, k] + g * g) ** 0.5 - n[c, k] ** 0.5) / langid.ALPHA * w[c][k]
                n[c, k] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_code_lengths_are_optimal():
    def huffman(counts):
        heap = [(int(c), i, 0) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        total = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            total += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], a[1], 0))
        return total

    rng = np.random.default_rng(2)
    for n in (2, 3, 17, 200):
        counts = rng.integers(1, 1000, n)
        assert int((token_file.limited_lengths(counts, 18) * counts).sum()) == huffman(counts)


def test_many_urls_take_linear_time():
    for junk in ("www.", "a://", "://", "awww.", "a@", "token "):
        began = time.process_time()
        pii.find(junk * 40_000)
        assert time.process_time() - began < 5


def test_pipeline(spark, docs):
    rows = entry.queries()["pipeline"](spark, SF_DIR).collect()
    kept = {r.doc_id for r in rows}
    assert 0 < len(rows) == len(kept) < docs.count()
    near, leaks = run(spark, "op7_simhash_near_dedup"), run(spark, "op5_benchmark_decontamination")
    assert kept == {i for i, r in near.items() if r.component_id == i and not leaks[i].contaminated and i in kept} and all(
        i in kept for i, r in near.items() if r.component_id == i and not leaks[i].contaminated and r.fingerprint != "0" * 16
    )
