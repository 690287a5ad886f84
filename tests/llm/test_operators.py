"""Operators of the training-data subpackage against brute force, on small tables."""

import base64
import collections
import hashlib
import math
import random
import re
from decimal import Decimal

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from premia.llm import bpe, licenses, minhash, mixing, ngrams, passages, pii, pivots, rules, simhash, toxicity
from premia.llm.graph import components
from premia.session import written

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOWELS, STARTS = "aeiou", "bcdfgklmnprst"


def words(rng, n, size=400):
    vocabulary = [a + b + c + d for a in STARTS for b in VOWELS for c in STARTS[:4] for d in VOWELS][:size]
    return [rng.choice(vocabulary) for _ in range(n)]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use themselves."""
    rng = random.Random(7)
    long = " ".join(words(rng, 20_000))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (None, "some words here", "en", None), (3, long, "en", "a"), (4, long, None, "a"),
        (5, "x", "en", "b"), (5, "x", "en", "b"), (6, " \n\t ", "de", ""), (None, None, None, None), (7, "a b", "en", "a"), (8, "a b", "en", "a"),
    ]
    clash = ["row", "id", "slot", "rank", "block", "key", "print", "n_words", "kept", "h", "bucket", "_kept", "_id", "_text", "doc", "place", "weight"]
    return documents(spark, rows).withColumns({c: F.lit("clash") for c in clash})


OPERATORS = {
    "simhash": simhash.simhash_components,
    "keep_one": minhash.keep_one,
    "pii": pii.scan,
    "replace_text": pii.replace_text,
    "bpe": lambda d: bpe.encode(d, PATH, PATTERN),
    "passages": passages.repeated_passages,
    "rules": rules.judge,
    "keep_good": rules.keep_good,
    "licenses": licenses.scan,
    "backoff": lambda d: ngrams.backoff_scores(d, PATH, PATTERN),
    "mixing": mixing.mix,
    "interleave": mixing.interleave,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](odd.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS.keys() - {"keep_one", "passages", "keep_good"}))
def test_odd_rows_all_come_back(odd, name):
    got = [r["doc_id"] for r in OPERATORS[name](odd).select("doc_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [r["doc_id"] for r in odd.select("doc_id").collect()]))


def test_odd_rows_of_filters(odd):
    assert sorted(r["doc_id"] for r in rules.keep_good(odd).collect()) == [3, 4]
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "5", "7", "None", "None"]
    spans = {r["doc_id"]: r for r in passages.repeated_passages(odd).collect()}
    assert set(spans) == {3, 4} and spans[4]["class_id"] == 3 and spans[3]["last_word"] - spans[3]["first_word"] > 19_900


def test_odd_rows_of_digests(odd):
    tokens = {r["doc_id"]: r for r in bpe.encode(odd, PATH, PATTERN).collect()}
    assert tokens[1]["n_tokens"] == 0 and tokens[1]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    scores = {r["doc_id"]: r for r in ngrams.backoff_scores(odd, PATH, PATTERN).collect()}
    assert scores[2]["log_score"] == 0 and scores[2]["mean_score"] is None
    assert {r["text"] for r in pii.scan(odd).where("doc_id = 1").collect()} == {None}


# SimHash


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    table = simhash.golay_offsets()
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (2, 3000)).astype(np.uint64)
    b = a ^ flips[0] ^ np.where(rng.random(3000) < 0.7, flips[1], np.uint64(0))
    keys = []
    for v in (a, b):
        at, k = simhash.fuzzy_keys(v, table)
        sets = collections.defaultdict(set)
        for i, x in zip(at.tolist(), k.tolist()):
            sets[i].add(x)
        keys.append(sets)
    assert all(keys[0][i] & keys[1][i] for i in range(3000)) and max(map(len, keys[0].values())) <= 18


def closure(values, linked):
    low = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if linked(values[i], values[j]) and low[i] != low[j]:
                    a, b = sorted((low[i], low[j]))
                    low = [a if x == b else x for x in low]
                    changed = True
    return low


@pytest.mark.parametrize("limit", [64, 2])
def test_links_join_all_within_two_bits(spark, limit):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)}
    prints |= {rng.getrandbits(64) for _ in range(40)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "print long")
    pairs = {(r["a"], r["b"]) for r in simhash.links(df, pair_limit=limit).collect()}
    near = lambda a, b: bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2
    assert all(near(a, b) for a, b in pairs)
    assert closure(signed, near) == closure(signed, lambda a, b: (a, b) in pairs or (b, a) in pairs)


@pytest.mark.parametrize("limit", [64, 3])
def test_keep_one_at_shingle_similarity(spark, limit):
    """Texts with a few replaced words are one group where their shingle sets are alike, and stay where they aren't."""
    rng = random.Random(13)
    texts = []
    for _ in range(30):
        base = words(rng, 150)
        texts.append(base)
        for share in (0.005, 0.02, 0.03, 0.3):
            texts.append([rng.choice(STARTS) + "zz" if rng.random() < share else w for w in base])
    texts += [words(rng, 120)[: 40 + i] for i in range(10)]
    made = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    low = closure(made, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    want = {i for i in range(len(texts)) if low[i] == i}
    assert 30 < len(want) < len(texts) - 40
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    got = [r["doc_id"] for r in minhash.keep_one(documents(spark, rows), pair_limit=limit).collect()]
    assert sorted(got) == sorted(want)
    same_id = documents(spark, [(1, "a b c d e f g", "en", "s"), (2, "other words that stand here alone", "en", "s"), (2, "a b c d e f g", "en", "s"), (2, "A b c d e f g", "en", "s")])
    assert sorted(r["doc_id"] for r in minhash.keep_one(same_id).collect()) == [1, 2]


def test_licence_texts_are_cut_into_words_once(spark, monkeypatch):
    rows = [(1, "x Under the MIT license y", "en", "s"), (2, None, "en", "s"), (3, "cc by nc cc by nc", "en", "s"), (4, "a b", "en", "s")]
    calls, cut = [], licenses.words_of
    monkeypatch.setattr(licenses, "words_of", lambda c: calls.append(1) or cut(c))
    for limit in (5000, 0):
        monkeypatch.setattr(licenses, "HASHES", limit)
        got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"]) for r in licenses.scan(documents(spark, rows)).collect()}
        assert got == {1: (6, 1, 1, 1, "mit"), 2: (0, 0, None, None, ""), 3: (6, 2, 0, 3, "cc-by-nc"), 4: (2, 0, None, None, "")}
    assert len(calls) == 2


def test_fuzzy_keys_of_similar_sets_meet():
    """Golay-code keys: equal anchor and words within 2 bits give a common key, so sets of similarity 0.8 meet, few unlike ones do."""
    rng = np.random.default_rng(8)
    table = simhash.golay_offsets()
    met = {0.8: 0, 0.3: 0}
    for similarity in met:
        for _ in range(300):
            both = round(200 * similarity)
            a, b = (np.unique(x) for x in np.split(rng.integers(0, 1 << 63, 2 * (200 - both), dtype=np.uint64), 2))
            common = rng.integers(0, 1 << 63, 2 * both, dtype=np.uint64)  # of 400 in all
            (x, u), (y, v) = (minhash.fuzzy_keys(np.union1d(common, s), table) for s in (a, b))
            met[similarity] += len(np.intersect1d(x, y)) > 0
            assert minhash.PRINTS <= len(x) <= 6 * minhash.PRINTS and len(np.unique(x)) == len(x)
            differ = int(np.bitwise_count((u ^ v).view(np.uint64)).sum())
            assert abs(differ - minhash.PRINTS * minhash.BITS * (1 - similarity) / 2) < 50
    assert met[0.8] >= 297 and met[0.3] <= 110
    assert len(minhash.fuzzy_keys(np.empty(0, np.uint64), table)[0]) == 0


def test_fingerprint_by_definition():
    text = "The  Quick brÜn\tfox JUMPS the quick brÜn fox"
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(len(w) - 2)]
    want = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    assert simhash.fingerprint(text.encode()) & ((1 << 64) - 1) == want and simhash.fingerprint(None) == 0 == simhash.fingerprint(b" \n")


# Tokens


def test_tokens_equal_tiktoken():
    entries = bpe.read_ranks(PATH)
    codec = bpe.Codec(entries, bpe.serialise(entries), PATTERN)
    rng = random.Random(5)
    texts = [e.decode("utf-8", "replace") for e in entries] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x2FFF), 9, 10, 28, 32, 0x3000, 0x1F600])) for _ in range(60)) for _ in range(500)]
    texts += ["".join(chr(c) for c in range(0x250)), " \n  \t x", "don't I'LL we've", "a" * 5000, "\0▁ ▁x"]
    for t in texts:
        got = codec.encode(t)
        assert got.tolist() == TIKTOKEN.encode_ordinary(t), repr(t[:80])
        assert codec.decode(got) == t.encode()


# Rules and licences


def test_rule_counts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcde") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))).replace("a b", "a\n#b") for _ in range(60)] + ["Éa\n\n a\n \na", "a a a a"]
    got = rules.text_counts(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(covered), len(lines) - len(set(lines)))
        assert r["n_symbols"] == sum(t.count(c) for c in rules.SYMBOLS)


def test_rules_adapt_to_their_group(spark):
    """The same share of capitals is usual in one source and far out in another."""
    rng = random.Random(4)
    text = lambda share: " ".join(w.upper() if rng.random() < share else w for w in words(rng, 120))
    rows = [(i, text(0.9), "en", "loud") for i in range(300)] + [(1000 + i, text(0.02), "en", "plain") for i in range(300)] + [(5000, text(0.9), "en", "plain")]
    kept = {r["doc_id"] for r in rules.judge(documents(spark, rows)).where("kept").collect()}
    assert kept == {r[0] for r in rows} - {5000}


def test_good_rows_stay_whatever_their_id(spark):
    rng = random.Random(8)
    good = " ".join(words(rng, 120))
    rows = [(None, good, "en", "s"), (1, good, "en", "s"), (1, "junk", "en", "s"), (2, good, None, None), (None, "junk", "en", "s"), (3, None, "en", "s")]
    kept = rules.keep_good(documents(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "None"] and all(r["text"] == good for r in kept)


def test_licence_places(spark):
    notice = licenses.NOTICES[0][1].split()
    altered = notice[:8] + ["extra"] + notice[8:20] + notice[21:]
    texts = ["Released UNDER the MIT license, under the mit-license!", "cc by nc by nc", "under the mit", " ".join(altered), " ".join(notice[:10]), "x apache-license version 2.0"]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    assert [(got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"]) for i in range(6)] == [
        (2, 1, 5, "mit"), (1, 0, 0, "cc-by-nc"), (0, None, None, ""), (0, None, None, ""), (0, None, None, ""), (1, 1, 1, "apache-2")]
    assert got[3]["labels"] == "mit" and got[3]["score"] > 0.8 and got[4]["labels"] == ""


# Privacy


def test_feistel_is_a_permutation(spark):
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    made = [r[0] for r in digits.select(pii.feistel_text(F.col("v"), "k", "t")).collect()]
    assert len(set(made)) == 10_000 and all(re.fullmatch("[0-9]{4}", x) for x in made)
    sizes = (7, 31)
    pairs = spark.range(7 * 31).select(pii.feistel_numbers(F.col("id") % 7, F.floor(F.col("id") / 7), sizes, "k", "t").alias("p")).collect()
    assert {(r["p"]["a"], r["p"]["b"]) for r in pairs} == {(a, b) for a in range(7) for b in range(31)}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    card, iban = "4111111111111111", "DE89370400440532013000"
    values = [card, "4111-1111-1111-1111", "9807915762804491", "+1 (017) 555-7713", "017-555-7713", "123-45-6789", "2024-02-29", "29.02.2024", "02/29/2024", "8.8.4.4", iban, "jane.doe7@mail3.example.com", "9233a8ecf7c5b09fe5949719b6b82bc4"]
    plain = ["666-12-0000", "2023-02-30", "300.1.2.3", "1.2.3", "12345", "v1.2.3.4.5", "no digits"]
    text = " | ".join(values + plain)
    rows = spark.createDataFrame([(1, text), (2, f"again {card}.")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.scan(rows).collect()}
    new = out[1]["text"].split(" | ")
    assert new[len(values):] == plain and all(a != b for a, b in zip(values, new)) and out[1]["n_private"] == len(values)
    assert all(re.sub("[0-9]", "9", a) == re.sub("[0-9]", "9", b) for a, b in zip(values[:10], new[:10]) if a != "8.8.4.4")
    assert luhn(new[0]) and new[1].replace("-", "") == new[0] and out[2]["text"] == f"again {new[0]}."
    assert re.sub(r"\D", "", new[3])[1:] == re.sub(r"\D", "", new[4])
    assert new[6].split("-") == new[7].split(".")[::-1] == [new[8].split("/")[i] for i in (2, 0, 1)]
    assert all(0 <= int(x) < 256 for x in new[9].split("."))
    assert int("".join(str(int(c, 36)) for c in new[10][4:] + new[10][:4])) % 97 == 1
    assert new[11].endswith("@mail3.example.com") and re.fullmatch(r"[a-z]{4}\.[a-z]{3}[0-9]", new[11].split("@")[0])
    assert re.fullmatch("[0-9a-f]{32}", new[12])
    assert pii.scan(rows, key="other").collect()[0]["text"] != out[1]["text"]


# Passages


def test_passages_that_repeat(spark):
    rng = random.Random(9)
    shared, edited, short = words(rng, 60), words(rng, 200), words(rng, 30)
    near = [w if i % 60 != 30 else "changed" for i, w in enumerate(edited)]
    own = lambda n: words(rng, n)
    texts = {1: own(80) + shared + own(40), 2: shared + own(90), 3: own(10) + edited + own(5), 4: own(33) + near, 5: own(50) + short + own(50), 6: short + own(80), 7: own(300), 8: own(20)}
    rows = {}
    for r in passages.repeated_passages(documents(spark, [(i, " ".join(t), "en", "s") for i, t in texts.items()])).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert set(rows) == {1, 2, 3, 4} and {r["class_id"] for i in (1, 2) for r in rows[i]} == {1} and {r["class_id"] for i in (3, 4) for r in rows[i]} == {3}
    span = rows[1][0]
    assert 76 <= span["first_word"] <= 92 and 126 <= span["last_word"] <= 140


def shared_shingles(a: str, b: str) -> float:
    """The largest similarity of five-word shingles of 50-word windows of two texts, by brute force over all pairs of places."""
    grams = lambda t: [tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)]
    x, y = grams(a), grams(b)
    best = 0.0
    for i in range(len(x) - 45):
        u = set(x[i : i + 46])
        for j in range(len(y) - 45):
            both = len(u.intersection(y[j : j + 46]))
            best = max(best, both / (92 - both))
    return best


def test_passages_with_a_word_more_or_less_and_a_common_line(spark):
    rng = random.Random(4)
    own = lambda n: words(rng, n, 9000)
    texts, partner = {}, {}
    line = own(30)
    for i in range(30):
        texts[i] = own(20) + line + own(20)
    for i in range(30, 130, 2):
        kind, n = i // 2 % 5, rng.randint(55, 75)
        if kind == 4:
            passage = own(rng.randint(3, 18))
            passage += line + own(24 - len(passage))
        else:
            passage = own(n)
        near, at = list(passage), len(passage) // 2
        near[at : at + (kind in (1, 2))] = [] if kind in (0, 2, 4) else ["more"]
        if kind == 3:
            near[at:at] = ["else"]
        texts[i], texts[i + 1] = own(30) + passage + own(25), own(20) + near + own(30)
        partner[i], partner[i + 1] = i + 1, i
    joined = {i: " ".join(t) for i, t in texts.items()}
    rows = passages.repeated_passages(documents(spark, [(i, t, "en", "s") for i, t in joined.items()])).collect()
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    wanted = [i for i in range(30, 130, 2) if shared_shingles(joined[i], joined[i + 1]) >= 0.8]
    found = [i for i in wanted if classes.get(i, -1) == classes.get(i + 1, -2)]
    assert len(wanted) >= 40 and len(found) >= 0.9 * len(wanted)
    alike = lambda i, j: shared_shingles(joined[i], joined[j]) >= 0.6
    assert all(c == i or alike(i, c) for i, c in classes.items())


def test_passages_of_one_like_the_first_and_one_unlike_it(spark):
    """Around a line the first text shares 44 words with the second and 38 with the third; those two share 50 of the same keys."""
    rng = random.Random(41)
    own = lambda n: words(rng, n, 9000)
    texts = {}
    for i in range(0, 600, 3):
        line, before, after = own(38), own(6), own(12)
        texts[i] = own(20) + before + line + own(20)
        texts[i + 1] = own(20) + before + line + after + own(20)
        texts[i + 2] = own(20) + line + after + own(20)
    rows = [(i, " ".join(t), "en", "s") for i, t in texts.items()]
    keys = {i: set(passages.windows(t.encode())[0].tolist()) for i, t, *_ in rows}
    meet = [i for i in range(0, 600, 3) if keys[i + 1] & keys[i + 2]]
    hidden = [i for i in meet if not (keys[i + 1] & keys[i + 2]) - keys[i]]
    assert len(hidden) > 10
    for limit in (64, 1):
        classes = {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(documents(spark, rows), pair_limit=limit).collect()}
        assert [i for i in meet if classes.get(i + 1, -1) != classes.get(i + 2, -2)] == []


def test_passages_at_another_place_of_the_first_text(spark):
    rng = random.Random(43)
    own = lambda n: words(rng, n, 9000)
    rows = []
    for i in range(0, 120, 2):
        line, after = own(34), own(16)
        rows += [(i, " ".join(own(20) + line + own(40) + line + after + own(20)), "en", "s"), (i + 1, " ".join(own(20) + line + after + own(20)), "en", "s")]
    classes = {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(documents(spark, rows)).collect()}
    keys = {i: set(passages.windows(t.encode())[0].tolist()) for i, t, *_ in rows}
    meet = [i for i in range(0, 120, 2) if keys[i] & keys[i + 1]]
    assert len(meet) > 40 and all(classes.get(i) == i and classes.get(i + 1) == i for i in meet)


def test_agreeing_codes_shift_and_end_with_the_text():
    rng = random.Random(6)
    passage = words(rng, 60, 9000)
    a, b = " ".join(passage).encode(), " ".join([*passage[:25], "more", *passage[25:]]).encode()
    keys, places, around = passages.windows(a)
    others = {k: j for j, k in enumerate(passages.windows(b)[0].tolist())}
    met = [(i, others[k]) for i, k in enumerate(keys.tolist()) if k in others]
    there = passages.windows(b)
    good, first, last, other_first, other_last = passages.agreeing(around[[i for i, _ in met]], there[2][[j for _, j in met]])
    assert good.all()
    for n, (i, j) in enumerate(met):
        assert 0 <= places[i] + first[n] and places[i] + last[n] <= 55 and 0 <= there[1][j] + other_first[n] and there[1][j] + other_last[n] <= 56
    assert passages.windows(a, bare=True)[1].tolist() == places.tolist()


def test_wide_nodes_are_window_minima():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 62, 500, dtype=np.uint64)
    mixed = passages._mix(h ^ np.uint64(5))
    assert passages.wide_nodes(h, 5, 40).tolist() == [i + int(np.argmin(mixed[i : i + 40])) for i in range(461)]


# Embeddings


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(60, 200):
        v = base[i % 60] / np.linalg.norm(base[i % 60]) + rng.normal(size=16) * rng.choice([0.02, 0.08, 0.13])
        rows.append((i, v.tolist()))
    rows += [(200, rows[0][1]), (201, (2 * base[0]).tolist()), (202, None), (203, [0.0] * 16), (204, [float("nan")] * 16), (205, [None] * 16), (206, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r["vec_id"]: r for r in pivots.link_components(df, pivots=32, near=6, shared=2, block=8).collect()}
    x = np.array([v for i, v in rows if i < 202])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    found = sum(got[i]["n_links"] for i in range(202))
    assert len(got) == len(rows) and linked.sum() * 0.9 <= found <= linked.sum()
    assert all(got[i]["n_links"] <= linked[i].sum() for i in range(202))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(202, 207))
    assert got[200]["component_id"] == got[201]["component_id"] == 0 and not got[200]["kept"]
    whole = {r["vec_id"]: r["n_links"] for r in pivots.link_components(df, pivots=4, near=4, shared=1, block=8).collect()}
    assert all(whole[i] == linked[i].sum() for i in range(202))  # with one list for all, nothing is left out
    assert pivots.link_components(df.where("false")).count() == 0


@pytest.mark.parametrize("cosine, others", [(0.92, 900), (0.97, 900), (0.95, 3)])
def test_links_inside_a_dense_group(spark, cosine, others):
    """A third of the rows, or nearly all, are distinct near copies around one centre."""
    rng = np.random.default_rng(5)
    unit = lambda n: (lambda v: v / np.linalg.norm(v, axis=1, keepdims=True))(rng.normal(size=(n, 64)))
    x = np.concatenate([np.sqrt(cosine) * unit(1) + np.sqrt(1 - cosine) * unit(450), unit(others)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in pivots.link_components(df, block=256).collect()}
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    found = sum(r["n_links"] for r in got.values())
    assert linked.sum() * 0.9 <= found <= linked.sum() and all(got[i]["n_links"] <= linked[i].sum() for i in got)
    assert {got[i]["component_id"] for i in range(450)} == {0}


# Language model


@pytest.mark.parametrize("order", [2, 3])
def test_backoff_by_definition(spark, order):
    rng = random.Random(order)
    texts = [" ".join(words(rng, rng.randint(0, 25), 12)) for _ in range(40)] + [None, "", "x"]
    tokens = [TIKTOKEN.encode_ordinary(t or "") for t in texts]
    counts = collections.Counter()
    for t in tokens:
        padded = ["<s>", *t]
        for n in range(1, order + 1):
            counts.update(tuple(padded[i : i + n]) for i in range(len(padded) - n + 1) if not (n == 1 and i == 0))
        counts[("<s>",)] += bool(t)
    n_all = sum(map(len, tokens))

    def s(gram):
        if len(gram) == 1:
            return counts[gram] / n_all
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= 2 else 0.4 * s(gram[1:])

    got = ngrams.backoff_scores(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), PATH, PATTERN, order=order, block_tokens=150).collect()
    for r in got:
        t = tokens[r["doc_id"]]
        want = sum(math.log(s(tuple(["<s>", *t][max(0, i + 2 - order) : i + 2]))) for i in range(len(t)))
        assert r["n_tokens"] == len(t) and r["log_score"] == pytest.approx(want, abs=1e-9)


def test_backoff_splits_frequent_contexts(spark, monkeypatch):
    rng = random.Random(8)
    docs = documents(spark, [(i, " ".join(rng.choice(["the", "a", "of"]) + " " + w for w in words(rng, 30, 40)), "en", "s") for i in range(60)])
    scores = lambda: {r["doc_id"]: r["log_score"] for r in ngrams.backoff_scores(docs, PATH, PATTERN, block_tokens=300).collect()}
    one = scores()
    monkeypatch.setattr(ngrams, "BUCKET_ENTRIES", 200)
    monkeypatch.setattr(ngrams, "CONTEXT_ENTRIES", 16)
    assert scores() == pytest.approx(one, abs=1e-9)
    counts = np.array([1, 254, 255, 256, 1 << 33, 0])
    assert ngrams._unpacked_counts(ngrams._packed_counts(counts), 6).tolist() == counts.tolist()


# Mixing


def test_every_source_keeps_within_one_block():
    weights = mixing.whole_weights({"a": 5.0, "b": 1.0, "c": 0.3, "d": 2.2}, 100)
    schedule = mixing.period_schedule(weights)
    assert sum(weights.values()) == 100 and [x[2] for x in schedule] == list(range(100))
    given = collections.Counter()
    for s, j, slot in schedule:
        assert j == given[s]
        given[s] += 1
        assert all(abs(given[k] - weights[k] * (slot + 1) / 100) < 1 for k in weights)


def test_mix_places_every_row_once(spark):
    rows = [(i, "t", "en", "big" if i % 3 else f"s{i % 7}") for i in range(900)]
    df = documents(spark, rows)
    got = mixing.mix(df, block_rows=4, period=50).orderBy("slot", "rank").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(900)) and len({(r["slot"], r["rank"]) for r in got}) == 900
    blocks = collections.Counter((r["source"], r["block"]) for r in got)
    sizes = collections.Counter(r[3] for r in rows)
    assert all(n == 4 or b == (sizes[s] - 1) // 4 for (s, b), n in blocks.items())
    total = sum({r["source"]: r["weight"] for r in got}.values())
    for r in got:
        due = r["weight"] * r["slot"] / total
        assert due - 1 < r["block"] < due + 1
    out = mixing.interleave(df, block_rows=4, period=50)
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [r["doc_id"] for r in got]
    with pytest.raises(ValueError):
        mixing.mix(df, weights={"big": 1.0})


# Toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(11)
    insults = ["zonk", "plib", "grob"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 9 == 0
        w = words(rng, rng.randint(30, 200))
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w), "en", "s"))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(toxic)))
    docs = documents(spark, rows + [(5000, None, None, None), (None, "zonk", None, None)])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    assert len(got) == 1502 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"]]
    caught = [r for r in held if r["predicted"]]
    assert all(r["doc_id"] % 9 == 0 for r in caught) and len(caught) > 0.8 * sum(r["doc_id"] % 9 == 0 for r in held) and len(held) > 400
    assert [r["predicted"] for r in got if r["doc_id"] == 5000] == [0]
    flipped = known.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in got)  # labels of held-out rows change nothing
    assert {r["score"] for r in toxicity.toxicity(docs, known.where("false")).collect()} == {0.0}
    assert toxicity.toxicity(docs.where("false"), known).count() == 0


def test_toxicity_reads_no_held_out_text(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(words(rng, 40) + ["zonk"] * (i % 9 == 0)), "en", "s") for i in range(600)]
    docs = documents(spark, rows)
    known = spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    other = docs.withColumn("text", F.when(toxicity.held_out(F.col("doc_id")), F.lit("quite another text here")).otherwise(F.col("text")))
    other = other.unionByName(documents(spark, [(None, f"no id {i}", "en", "s") for i in range(300)]))
    a, b = (toxicity.train(d.repartition(1).sortWithinPartitions("doc_id"), known) for d in (docs, other))
    first = lambda t: {i: a.score(toxicity.word_ids(x.encode())) for i, x, *_ in t}
    second = {i: b.score(toxicity.word_ids(x.encode())) for i, x, *_ in rows}
    assert first(rows) == pytest.approx(second, abs=1e-9)


def test_keep_one_in_a_dense_group(spark):
    """Texts of one template, half of them alike to under 0.8, share keys by the hundred: links are those of brute force."""
    rng = random.Random(29)
    base = words(rng, 120)
    texts = []
    for i in range(220):
        own = [w if k % 120 > 8 + rng.randrange(24) else f"w{i}x{k}" for k, w in enumerate(base)]
        texts.append(own)
        if i % 4 == 0:
            texts.append([w if k != 70 else f"v{i}" for k, w in enumerate(own)])
    made = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    low = closure(made, alike)
    want = {i for i in range(len(texts)) if low[i] == i}
    assert 20 < len(want) < len(texts) - 20
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    got = {r["doc_id"] for r in minhash.keep_one(documents(spark, rows), pair_limit=8).collect()}
    assert got == want


def test_near_duplicate_pairs_are_sorted_out_by_their_bits_within_the_join(spark):
    """Of 40 classes of one key only those with near bits become rows, and never one of a component they are both in."""
    rng = np.random.default_rng(31)
    bits = rng.integers(-(1 << 63), (1 << 63) - 1, (40, 5)).tolist()
    bits[7] = [bits[3][0] ^ 6, *bits[3][1:]]
    bits[9] = list(bits[5])
    schema = "key long, c decimal(38,0), root decimal(38,0), bits array<long>"
    met = spark.createDataFrame([(1, Decimal(i), Decimal(5 if i == 9 else i), b) for i, b in enumerate(bits)], schema)
    assert [(int(r["a"]), int(r["b"])) for r in minhash._within_keys(met, 0.8).collect()] == [(3, 7)]


def test_keep_one_shuffles_no_texts_for_few_dropped_rows(spark):
    """Whatever the broadcast threshold, rows are held against the counted ids that drop out."""
    rows = [(i, " ".join(words(random.Random(i % 30), 60)), "en", "s") for i in range(40)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash.keep_one(documents(spark, rows))
        assert re.search(r"BroadcastHashJoin[^\n]*LeftAnti", kept._jdf.queryExecution().executedPlan().toString())
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_components_of_stars_take_no_round_and_rounds_leave_one_table(spark):
    edges = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    for pairs, wanted in (
        ([(1, 5), (5, 1), (2, 1), (7, 9), (3, 3)], {1: 1, 2: 1, 5: 1, 7: 7, 9: 7}),
        ([(i, i + 1) for i in range(10, 40)] + [(50, 60), (60, 70), (70, 50)], {i: 10 for i in range(10, 41)} | {50: 50, 60: 50, 70: 50}),
        ([], {}),
    ):
        before = written(spark)
        found = components(edges(pairs), "a", "b")
        assert len(written(spark)) == len(before) + 1
        assert {r["node"]: r["component"] for r in found.collect()} == wanted
        assert found.count() == len(wanted)


def test_near_duplicates_keep_only_the_tables_their_rows_need(spark):
    base = [f"w{i}" for i in range(200)]
    change = lambda n, at: " ".join(base[:at] + [f"x{n}"] + base[at + 1 :])
    rows = [(n, change(n, 3 * n)) for n in range(30)] + [(100, "alone in its words and not like any of the others"), (101, None), (101, change(0, 0))]
    before = written(spark)
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(written(spark)) <= len(before) + 4
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 100, 101]


def test_passages_alike_stand_once_in_the_groups_by_two_distances(spark, monkeypatch):
    rng = random.Random(8)
    own = lambda n: words(rng, n, 9000)
    passage = own(70)
    texts = [own(20) + passage + own(20) for _ in range(60)] + [own(20) + passage[20:50] + own(20) for _ in range(12)]
    wide = []

    def written_with(df, put=passages.materialize):
        out = put(df)
        if {"key", "at"} <= set(out.columns):
            wide.append(out.where(F.col("at") >= 1 << 32))
        return out

    monkeypatch.setattr(passages, "materialize", written_with)
    rows = passages.repeated_passages(documents(spark, [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]), pair_limit=4).collect()
    assert {r["doc_id"] for r in rows} == set(range(60)) and {r["class_id"] for r in rows} == {0}
    met = [r for df in wide for r in df.groupBy("key", "at").count().collect()]
    assert met and max(r["count"] for r in met) <= 20


@pytest.mark.parametrize("limit", [1, 3])
def test_groups_by_two_distances_by_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = [(key, at, u, root) for key in range(3) for u, root in ((u, u % 7 if u % 3 else 5) for u in range(40)) for at in rng.sample(range(6), rng.randint(0, 3 + u % 3))]
    few, heads = passages._by_two(spark.createDataFrame(rows, "key long, at int, u long, root long"), limit)
    groups = collections.defaultdict(set)
    ats = collections.defaultdict(set)
    for key, at, u, root in rows:
        ats[key, u, root].add(at)
    for (key, u, root), held in ats.items():
        for p in held:
            for q in held:
                if p < q:
                    groups[key, (p << 32) + q].add((root, u))
    groups = {k: v for k, v in groups.items() if len({root for root, _ in v}) > 1}
    assert sorted(map(tuple, few.collect())) == sorted((*k, u, root) for k, v in groups.items() if len(v) <= limit for root, u in v)
    wanted = {(k[0], *sorted((u, end[1]))) for k, v in groups.items() if len(v) > limit for end in (min(v), max(v)) for root, u in v if root != end[0]}
    assert wanted and {tuple(r) for r in heads.collect()} == wanted


def test_passages_of_crowded_keys_are_compared_throughout(spark, monkeypatch):
    """With few classes a key all pairs are compared; with many, no link may be lost: every third text has a like one whose shared words leave the line by three on each side."""
    rng = random.Random(17)
    own = lambda n: words(rng, n, 9000)
    line, texts = own(33), []
    for i in range(40):
        before, after = own(4), own(4)
        texts += [own(30) + before + line + after + own(30) for _ in range(1 + (i % 3 == 0))]
    rows = documents(spark, [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)])
    classes = lambda limit: {r["doc_id"]: r["class_id"] for r in passages.repeated_passages(rows, pair_limit=limit).collect()}
    wanted = classes(1000)
    assert len(set(wanted.values())) > 3
    monkeypatch.setattr(passages, "BLOCK", 7, raising=False)
    monkeypatch.setattr(passages, "AT_ONCE", 3, raising=False)
    assert classes(2) == wanted


def test_pairs_left_out_before_they_are_verified_would_all_fail():
    rng = np.random.default_rng(2)
    codes, line = rng.integers(0, 4, (150, 96)), rng.integers(0, 4, 96)
    for row in codes:
        first, by = rng.integers(20, 40), rng.integers(-3, 4)
        last = first + rng.integers(20, 40)
        row[first:last] = np.roll(line, by)[first:last]
    ends = np.where(rng.random((150, 2)) < 0.5, 48, rng.integers(20, 49, (150, 2)))
    around = np.concatenate([codes.reshape(150, 24, 4) @ [64, 16, 4, 1], ends], axis=1).astype(np.uint8)
    planes = passages._planes(around)
    i, j = np.divmod(np.arange(150 * 150), 150)
    good = passages.agreeing(around[i], around[j])[0].reshape(150, 150)
    held = passages._may_agree(planes[:, :64], planes), passages._may_agree(planes[:, 64:], planes)
    may = np.concatenate(held)
    assert good.sum() > 160 and not (good & ~may).any() and may.mean() < 0.2


def test_sets_of_the_similarity_share_one_of_their_least_shingles():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 45, 300) * 20:
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)])) for _ in range(2))
        if minhash.similar(x.tobytes(), y.tobytes()):
            assert set(minhash.prefix_keys(x, 0.8)) & set(minhash.prefix_keys(y, 0.8))
