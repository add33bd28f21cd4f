"""The contract queries against plain Python, on the given tables and on a table of odd rows."""

import hashlib
import random
import zlib
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tallybrook.llm import (
    decontaminate, fingerprints, language, licenses, near_duplicates, packing, privacy, quality, repeats, sharding,
)
from tallybrook.llm.base import table

MAKE = random.Random(11)
SYLLABLES = ["ka", "to", "mi", "ren", "sol", "ba", "dur", "é", "ñu", "pli", "qua", "zet"]


def sentence(words, make=MAKE):
    return " ".join("".join(make.choice(SYLLABLES) for _ in range(make.randint(1, 3))) for _ in range(words))


PASSAGE, ITEM = sentence(60), sentence(14)
LONG = sentence(30_000)
BASE_TEXT = sentence(120)
NEAR = BASE_TEXT.rsplit(" ", 3)[0] + " other words here"
ROWS = [
    (1, BASE_TEXT), (2, None), (3, ""), (4, LONG), (5, BASE_TEXT), (6, NEAR), (7, "one"), (8, "  \n\t "),
    (9, f"{sentence(5)} {PASSAGE} {sentence(9)}"), (10, f"{sentence(30)} {PASSAGE}"), (11, f"{ITEM.upper()} {sentence(3)}"),
    (12, "Mail a.b%c@x-y.example.org or 10.0.0.255, 4111 1111 1111 1111, +1 (555) 555-0100."),
    (13, "Under the MIT license; Apache License, Version 2.0. CC BY-NC 4.0 cc by nc"), (14, "🙂 漢字 ñ"),
    (15, "aa " * 400), (16, BASE_TEXT.upper()), (17, ITEM), (18, ITEM.rsplit(" ", 6)[0]), (19, "!!! ... 123 456"),
    (20, "under the mit licence under the mit license"), (21, LONG[:-1000]),
]
ODD = list(dict.fromkeys("__weight __noisy __key __id __of __kept __rows weight noisy of_id of_key kept rows row key row_number shard slot words pos start end spans node label id text_key found of kept lang lead window good bucket".split()))


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, two of them repeated and two without an id, beside columns with names the operators use."""
    rows = [*ROWS, ROWS[0], ROWS[3]]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, source string")
    return df.withColumns({name: F.lit(None).cast("string") for name in ODD}).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def nameless(spark):
    return spark.createDataFrame([(None, BASE_TEXT), (None, None), (7, "seven words are here in this text")],
                                 "doc_id long, text string")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, "--"), (4, "ka to"), (5, ITEM)], "item_id long, text string")


@pytest.fixture(scope="module")
def given(spark, data):
    docs = table(spark, data, "documents")
    return docs, [tuple(r) for r in docs.select("doc_id", "text").collect()]


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in rows}, len(rows)


# -- sharding -------------------------------------------------------------------

def check_shards(rows, texts, shards):
    sizes, places, homes = {}, {}, {}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1
        assert r["text_crc32"] == zlib.crc32((text or "").encode())
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault(text, set()).add(r["shard"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(h) == 1 for h in homes.values()) and set(places) <= set(range(shards))
    return sizes


def test_shards(given):
    docs, rows = given
    found = sharding.report(docs).collect()
    sizes = check_shards(found, dict(rows), 16)
    assert len(found) == len(rows) and max(sizes.values()) < 1.001 * sum(sizes.values()) / 16


def test_shards_of_odd_rows(odd, none, nameless):
    found = sharding.report(odd).collect()
    assert len(found) == len(ROWS) + 2
    check_shards(found, dict(ROWS), 16)
    assert sharding.report(none).count() == 0 and sharding.report(nameless).count() == 3


def test_best_fit_by_size_equals_one_by_one():
    make = random.Random(2)
    for _ in range(200):
        sizes, capacity = [make.randint(1, 30) for _ in range(make.randint(1, 80))], 40
        rooms = []
        for size in sorted(sizes, reverse=True):
            fit = [k for k, room in enumerate(rooms) if room >= size]
            k = min(fit, key=lambda k: rooms[k], default=None)
            if k is None:
                rooms.append(capacity - size)
            else:
                rooms[k] -= size
        counts = [(s, sizes.count(s)) for s in set(sizes)]
        runs = sharding.best_fit_decreasing(counts, capacity)
        used = {}
        for size, _, count, bin_ in runs:
            used[bin_] = used.get(bin_, 0) + size * count
        assert sorted(used.values()) == sorted(capacity - room for room in rooms)


def test_a_group_over_its_share_has_a_shard_of_its_own():
    runs = sharding.equal_shards([(1000, 1), (1, 300)], 4)
    assert sorted(sum(s * n for s, _, n, b in runs if b == k) for k in range(4)) == [100, 100, 100, 1000]


def test_equal_texts_without_ids_are_spread(spark):
    """A third of the rows alike: slots have no gaps and one shard takes them all."""
    rows = [(None, None)] * 3000 + [(k, f"text {k}") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sharding.report(docs, 4).collect()
    places = {}
    for r in found:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert len(found) == 9000 and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert len({r["shard"] for r in found if r["doc_id"] is None}) == 1


# -- personal data --------------------------------------------------------------

def test_personal_data(given, odd, none, nameless):
    docs, rows = given
    for df, texts in ((docs, dict(rows)), (odd, dict(ROWS))):
        for r in privacy.report(df).collect():
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute.personal(texts[r.doc_id])
    assert privacy.report(odd).count() == len(ROWS) + 2 and privacy.report(none).count() == 0
    assert privacy.report(nameless).filter("doc_id is null").count() == 2


def test_anchor_parsers_equal_patterns():
    make = random.Random(5)
    parts = ["1", "25", "255", "256", ".", "-", " ", "@", "+", "+1", "a", "b.c", "%", "(", ")", "é", "4111111111111111", "x@y.z", "0"]
    for _ in range(5000):
        text = "".join(make.choice(parts) for _ in range(make.randint(0, 30)))
        found = privacy.spans_of(text)
        joined = ",".join(f"{k}:{a}:{b}" for k in privacy.BASE_KINDS for a, b in found[k])
        assert hashlib.sha256(joined.encode()).hexdigest() == brute.personal(text)[-1], text


def test_accounts_in_their_usual_forms():
    def accounts(text):
        return [text[a:b] for a, b in privacy.spans_of(text)["account"]]

    for text, want in (
        ("account number: 12345678.", "12345678"), ("account no. 12345678", "12345678"), ("Account ID is 1234 5678 9012", "1234 5678 9012"),
        ("IBAN: DE89 3704 0044 0532 0130 00 and more", "DE89 3704 0044 0532 0130 00"), ("iban nr GB82WEST12345698765432", "GB82WEST12345698765432"),
        ("password: hunter22x", "hunter22x"), ("api_key=ab12cd34", "ab12cd34"), ("account token 12345678", "12345678"),
        ("IBAN: NL91 ABNA 0417 1643 00", "NL91 ABNA 0417 1643 00"),
    ):
        assert accounts(text) == [want], text
    for text in ("IBAN: DE89 3704 0044 0532 0130 01", "IBAN DE89370400440532013000X", "account number of things", "accountant 12345678", "account number", "iban"):
        assert accounts(text) == [], text


def test_redaction(odd):
    rows, _ = by_id(privacy.redacted(odd), "text", "source")
    assert rows[2] == (None, "x") and rows[1] == (BASE_TEXT, "x")
    assert rows[12][0] == "Mail [email] or [ip], [card], [phone]."
    assert privacy.redacted(odd).columns == odd.columns


# -- near duplicates ------------------------------------------------------------

@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(given, size):
    docs, rows = given
    found, count = by_id(near_duplicates.cluster(docs, size=size), "n_shingles", "component_id", "kept")
    assert found == brute.near_components(rows, size) and count == len(rows)


def test_near_duplicates_of_odd_rows(odd, none, nameless):
    found, count = by_id(near_duplicates.cluster(odd, size=4), "n_shingles", "component_id", "kept")
    assert found == brute.near_components(ROWS) and count == len(ROWS) + 2
    assert near_duplicates.cluster(none).count() == 0
    assert near_duplicates.cluster(nameless).filter("doc_id is null and kept").count() == 2


def test_components_across_buckets(spark):
    """Links of a chain, of which no node is linked with all: one component."""
    make = random.Random(4)
    words = sentence(200, make).split()
    chain = []
    for k in range(12):
        chain.append((100 + k, " ".join(words)))
        for _ in range(3):
            words[make.randrange(len(words))] = f"w{k}"
    docs = spark.createDataFrame(chain, "doc_id long, text string")
    found, _ = by_id(near_duplicates.cluster(docs, size=4), "n_shingles", "component_id", "kept")
    assert found == brute.near_components(chain)


def test_unique_documents(odd):
    kept = near_duplicates.unique_documents(odd, size=4)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {k for k, v in brute.near_components(ROWS).items() if v[2]}


def test_rows_are_removed_by_id_and_text(spark):
    """Null ids, ids with two texts and repeated rows: one row of each component stays."""
    make = random.Random(31)
    a, b, c, d, e = (sentence(60, make) for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (None, c + " more"), (2, a), (2, d), (3, e), (3, e), (None, None)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, place int").repartition(3)
    left = [(r.doc_id, r.text) for r in near_duplicates.unique_documents(docs).collect()]
    assert len([t for _, t in left if t in (c, c + " more")]) == 1
    assert sorted((str(k), t or "") for k, t in left if t not in (c, c + " more")) == sorted(
        (str(k), t or "") for k, t in [(1, a), (None, b), (2, d), (3, e), (None, None)])
    marked = near_duplicates.cluster(docs).filter("doc_id is null and kept")
    assert marked.count() == 3


# -- packing --------------------------------------------------------------------

def check_packing(rows, texts, length=packing.LENGTH):
    encode = partial(packing.encoder(packing.VOCABULARY).encode, allowed_special=set(packing.SPECIAL), disallowed_special=())
    held, bins = {}, {}
    for r in rows:
        held.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    import numpy as np
    for doc, parts in held.items():
        ids = np.array([*encode(texts[doc] or ""), packing.END], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["piece"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]])
            assert r["piece"] == 0 or r["length"] == length
            at += r["length"]
        assert at == len(ids)
    return len(bins), -(-sum(r["length"] for r in rows) // length)


def test_packing(given):
    docs, rows = given
    used, least = check_packing(packing.report(docs).collect(), dict(rows))
    assert used <= least * 1.01 + 1


def test_packing_of_odd_rows(odd, none, nameless):
    rows = packing.report(odd.dropDuplicates(["doc_id"])).collect()
    check_packing(rows, dict(ROWS))
    assert {r["doc_id"] for r in rows} == {k for k, _ in ROWS}
    assert packing.report(none).count() == 0 and packing.report(nameless).filter("doc_id is null").count() == 2
    assert packing.report(odd).filter("doc_id = 1").count() == 2 * sum(r["doc_id"] == 1 for r in rows)


def test_ids_equal_the_tokenizers_file(given):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = [t for _, t in given[1][:300]] + [t or "" for _, t in ROWS] + ["a<|endoftext|>b", "it's  \n\n x'RE 'll"]
    encode = packing.encoder(packing.VOCABULARY).encode_ordinary
    assert [encode(t) for t in texts] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]


def test_special_tokens_are_found_as_by_default(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "a<|endoftext|>", "x <|endoftext| > <|pad|>", "it's  \n\n <|endoftext|>\n 'll"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, _ = by_id(packing.pieces(docs, with_ids=True), "ids")
    assert [found[k][0][:-1] for k in range(len(texts))] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]
    assert found[0][0][:-1] == [64, 220, 50256, 275]


def plain_best_two_fit(lengths, length, least):
    """The method on a list, by looking at all pairs."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_, gap = [], length
        while fit := [n for n in left if n <= gap]:
            left.remove(max(fit))
            bin_.append(max(fit))
            gap -= max(fit)
        if gap >= least and left:
            smallest = min(bin_)
            pairs = [(a + b, max(a, b), min(a, b)) for k, a in enumerate(left) for b in left[:k] if smallest < a + b <= gap + smallest]
            if pairs:
                _, a, b = max(pairs)
                bin_.remove(smallest)
                bin_ += [a, b]
                left.remove(a)
                left.remove(b)
                left.append(smallest)
        bins.append(sorted(bin_))
    return bins


def test_best_two_fit_equals_looking_at_all_pairs():
    make = random.Random(5)
    for _ in range(150):
        lengths = [make.randint(1, 40) for _ in range(make.randint(0, 40))]
        for least in (1, 3, 41):
            bins = packing.best_two_fit(lengths, 40, least)
            assert sorted(n for b in bins for n in b) == sorted(lengths) and all(sum(b) <= 40 for b in bins)
            assert [sum(b) for b in bins] == [sum(b) for b in plain_best_two_fit(lengths, 40, least)]
        best = len(packing.fewest_bins(lengths, 40))
        assert best <= min(len(plain_best_two_fit(lengths, 40, least)) for least in (1, 2, 41))


def test_equal_pieces_without_ids_are_spread(spark):
    """A third of the rows alike: no chunk holds more than its share."""
    rows = [(None, "")] * 1000 + [(k, f"text {k}") for k in range(2000)]
    packed = packing.pack(packing.pieces(spark.createDataFrame(rows, "doc_id long, text string")), chunk=100)
    chunks = packed.groupBy(F.shiftright("sequence_id", 32)).count().agg(F.max("count"), F.sum("count")).first()
    assert chunks[0] < 160 and chunks[1] == 3000


def test_two_that_fit():
    make = random.Random(8)
    for _ in range(500):
        lengths = [make.randint(1, 30) for _ in range(make.randint(0, 12))]
        counts, left = [0] * 65, 0
        for n in lengths:
            counts[n] += 1
            left |= 1 << n
        gap, more = make.randint(2, 40), make.randint(1, 20)
        sums = [a + b for k, a in enumerate(lengths) for b in lengths[:k] if more < a + b <= gap]
        pair = packing.two_that_fit(left, counts, gap, more)
        assert (sum(pair) if pair else None) == max(sums, default=None)


# -- quality --------------------------------------------------------------------

def test_importance_resampling(spark, given, data):
    docs, rows = given
    labels = table(spark, data, "labels")
    found = quality.report(docs, labels)
    rated = found.join(labels, "doc_id").collect()
    assert found.count() == len(rows)
    share = lambda rows: sum(r.kept for r in rows) / len(rows)
    assert share([r for r in rated if r.quality == 1 and not r.toxic]) > 0.97
    assert share([r for r in rated if r.toxic]) < 0.2


def test_resampling_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (19, 0, 0), (19, 1, 0), (99, 1, 1), (None, 1, 1), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    found = quality.report(odd, labels)
    assert found.count() == len(ROWS) + 2 and quality.report(none, labels).count() == 0
    assert {r.weight for r in found.filter("doc_id in (2, 3)").collect()} == {0.0}
    assert quality.resampled(odd, labels.limit(0)).count() == len(ROWS) + 2
    assert quality.resampled(odd, labels).columns == odd.columns


def test_all_log_ratios_weigh(spark):
    """Text like the target weighs more than none, and strings the target never holds weigh less."""
    make = random.Random(21)
    junk = ["".join(make.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(9)) for _ in range(4000)]
    rows = [(k, sentence(80, make) if k % 2 else " ".join(junk[20 * k:20 * k + 40])) for k in range(100)] + [(100, None)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    found, _ = by_id(quality.report(spark.createDataFrame(rows, "doc_id long, text string"), labels), "weight", "kept")
    clean, odd_ones = [found[k][0] for k in range(61, 100, 2)], [found[k][0] for k in range(60, 100, 2)]
    assert max(clean) > found[100][0] == 0.0 > max(odd_ones) and min(clean) > max(odd_ones)
    assert not any(found[k][1] for k in range(60, 100, 2))


def test_kth_largest(spark):
    values = [random.Random(1).choice([0.0, 1.5, -3.0, float(k)]) for k in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 150, 299, 300):
        assert quality.kth_largest(df, "v", k, bins=4) == sorted(values, reverse=True)[k - 1]


# -- decontamination ------------------------------------------------------------

COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination(spark, given, data):
    docs, rows = given
    items = table(spark, data, "benchmark")
    found, count = by_id(decontaminate.report(docs, items), *COLUMNS)
    assert found == brute.contaminated(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert count == len(rows)


def test_decontamination_of_odd_rows(odd, none, nameless, items):
    pairs = [tuple(r) for r in items.collect()]
    found, _ = by_id(decontaminate.report(odd, items), *COLUMNS)
    assert found == brute.contaminated(ROWS, pairs)
    clean = decontaminate.remove_contaminated(odd, items)
    assert clean.columns == odd.columns
    assert {r.doc_id for r in clean.collect()} == {k for k, v in found.items() if not v[-1]}
    assert decontaminate.report(none, items).count() == 0
    assert decontaminate.report(odd, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(nameless, items).count() == 3


def test_benchmark_in_blocks(monkeypatch, odd, items):
    whole = sorted(map(str, decontaminate.report(odd, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 500)
    assert sorted(map(str, decontaminate.report(odd, items).collect())) == whole


# -- fingerprints ---------------------------------------------------------------

def test_fingerprints(given):
    docs, rows = given
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    found, count = by_id(fingerprints.report(docs), "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    assert count == len(rows)
    errors = []
    for doc, after in zip(order, order[1:] + order[:1]):
        text, half = texts[doc], len(texts[doc]) // 2
        changed = text[:len(text) - half] + texts[after][:half]
        assert found[doc][:2] == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        errors += [found[doc][3] - brute.jaccard(text, changed), found[doc][4] - brute.jaccard(text, texts[after])]
    assert abs(sum(errors) / len(errors)) < 0.01 and sum(e * e for e in errors) / len(errors) < 0.0045
    same = {}
    assert all(same.setdefault(texts[d], found[d][2]) == found[d][2] for d in texts)


def test_fingerprints_of_odd_rows(spark, odd, none, nameless):
    found, count = by_id(fingerprints.report(odd.dropDuplicates(["doc_id"])), "n_chars", "edited_sha256", "fingerprint", "near_next")
    texts = dict(ROWS)
    order = sorted(texts, reverse=True)
    for doc, after in zip(order, order[1:] + order[:1]):
        text, half = texts[doc] or "", len(texts[doc] or "") // 2
        changed = text[:len(text) - half] + (texts[after] or "")[:half]
        assert found[doc][:2] == (len(text), hashlib.sha256(changed.encode()).hexdigest())
    assert found[2][2] == found[3][2] == found[8][2] == "" and found[3][3] == 1.0 and found[1][2] == found[5][2]
    assert fingerprints.report(odd).count() == len(ROWS) + 2 and fingerprints.report(none).count() == 0
    assert fingerprints.report(nameless).count() == 3
    one = fingerprints.report(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_long_unrelated_texts_are_unlike():
    """Terms are never merged; what is kept between texts does not change a fingerprint."""
    import pyarrow as pa

    long = [" ".join(f"{mark}{k}" for k in range(140_000)) for mark in "ab"]
    one, other = fingerprints.sketches(pa.array(long))
    assert fingerprints.likeness(one, other) < 0.05
    texts = [sentence(300) for _ in range(20)] + ["aa bb " * 300]
    first = [fingerprints._text(c) for c in fingerprints.sketches(pa.array(texts * 2))]
    fingerprints._kept.cache_clear()
    assert first == [fingerprints._text(fingerprints.sketches(pa.array([t]))[0]) for t in texts] * 2


# -- licenses -------------------------------------------------------------------

def test_license_base(given, odd, none, nameless):
    docs, rows = given
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    for df, texts in ((docs, rows), (odd, ROWS)):
        assert by_id(licenses.report(df), *columns)[0] == brute.license_base(texts)
    assert licenses.report(none).count() == 0 and licenses.report(nameless).count() == 3


def test_line_marks_beyond_ascii_are_word_characters(spark):
    rows = []
    for k, mark in enumerate("\u0085\u2028\u2029"):
        rows += [(4 * k, f"the end.{mark}Released under the MIT license"), (4 * k + 1, f"x{mark}y one two. Under the MIT license"),
                 (4 * k + 2, f"under the mit license and{mark}so on, cc by nc{mark}"), (4 * k + 3, f"under{mark}the mit license")]
    found, _ = by_id(licenses.report(spark.createDataFrame(rows, "doc_id long, text string")),
                     "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert found == brute.license_base(rows) and found[0][1] == 1


def test_license_labels(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "SPDX-License-Identifier: BSD-3-Clause"),
            (3, "Licensed under the GNU Lesser General Public License version 2.1"), (4, "Use the license you like."),
            (5, "Apache License, Version 2.0, and the Mozilla Public License 2.0")]
    found, _ = by_id(licenses.report(spark.createDataFrame(rows, "doc_id long, text string")), "labels", "score")
    assert found == {1: ("gpl-3", 1.0), 2: ("bsd-3", 1.0), 3: ("lgpl-2.1", 1.0), 4: ("", 0.0), 5: ("apache-2,mpl-2", 1.0)}


def test_license_wording_without_a_name(spark):
    rows = [
        (1, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
        (2, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"),
        (4, "Neither the name of X may be used to endorse or promote products derived from this software without"),
        (5, "You may not use this file except in compliance with the License."), (6, "Redistribution and use of this, free of charge."),
    ]
    found, _ = by_id(licenses.report(spark.createDataFrame(rows, "doc_id long, text string")), "labels")
    assert found == {1: ("bsd",), 2: ("isc",), 3: ("mit",), 4: ("bsd-3",), 5: ("apache-2",), 6: ("",)}
    for label, signature in licenses.WORDINGS:
        before, after = signature.replace("(?:and )?(?:or )?", "and or ").split("@")
        assert len(before.split()) <= licenses.BEFORE and len(after.split()) <= licenses.AFTER, (label, signature)


# Written by hand: what a text says, and the labels it should have.
LICENSED = {
    "GPL3": "gpl-3", "LGPL3": "lgpl-3", "MPL2": "mpl-2", "WTFPLv2": "wtfpl", "GNU GPL version 3": "gpl-3", "GPLv2": "gpl-2",
    "GNU General Public Licence v3": "gpl-3", "The MIT licence.": "mit", "LGPL v2.1": "lgpl-2.1", "AGPLv3": "agpl-3", "EPL 2.0": "epl-2",
    "CC BY 4.0": "cc-by", "CC BY-SA 4.0": "cc-by-sa", "CC BY-NC-ND 4.0": "cc-by-nc,cc-by-nc-nd", "CC0 1.0 Universal": "cc0",
    "licensed under Apache 2": "apache-2", "released under BSD": "bsd", "Apache-2.0": "apache-2", "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: 0BSD": "0bsd", "Two-clause BSD licence": "bsd-2", "the Boost Software License": "bsl",
    "Microsoft Public License": "ms-pl", "the PostgreSQL Licence": "postgresql", "the CeCILL-B licence": "cecill-b",
    "Llama 3 Community License": "llama", "Server Side Public License": "sspl", "Open Government Licence": "ogl-uk",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License":
        "agpl", "Unauthorized copying of this file, via any medium, is strictly prohibited": "proprietary",
    "If a copy of the MPL was not distributed with this file": "mpl-2", "All rights reserved.": "proprietary",
    "you just DO WHAT THE FUCK YOU WANT TO.": "wtfpl", "Educational Community License": "ecl", "ODbL": "odbl", "SIL OFL": "ofl",
}
PLAIN = (
    "3 Apache 2 engine planes", "in CC 0 people", "cc by john", "the driver's license was renewed", "an artistic career", "a beer in the park",
    "MIT students won", "a fair price", "zlib compresses", "the common public", "GPL is short", "vim and emacs", "subject to change", "python code",
    "public domain name server", "the Unicode standard", "an open database of birds", "reserved seats", "java and ruby", "the sun sets", "a poetic licence",
    "the elastic band", "commons debate", "press release",
)


def test_license_names_in_all_their_forms(spark):
    """Precision and recall are 1 on these."""
    rows = list(enumerate([*LICENSED, *PLAIN]))
    found, _ = by_id(licenses.report(spark.createDataFrame(rows, "doc_id long, text string")), "labels")
    wrong = {text: found[k][0] for k, text in rows if found[k][0] != LICENSED.get(text, "")}
    assert not wrong


def test_rules_are_hundreds_and_keys_are_rare_words():
    signatures = {s for _, s in (*licenses.SIGNATURES, *licenses.GRANTED, *licenses.WORDINGS)}
    assert len(signatures) > 300 and all(s.count("@") == 1 for s in signatures)
    keys = {key for s in signatures for key in licenses._keys(licenses._spelled(s))}
    assert not keys & set("a an the of to in and or is are be this that for with by on as you it software use".split())


def test_contained_detections_are_suppressed(spark):
    df = spark.createDataFrame([(1, "under the terms of the GNU General Public License version 2")], "doc_id long, text string")
    rows = licenses.outermost(licenses.detections(df)).filter("priority >= 0").collect()
    assert len(rows) > 2 and [r.label for r in rows if r.shown] == ["gpl-2"]


# -- language -------------------------------------------------------------------

def test_language(given):
    docs, rows = given
    found = language.report(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found) and len(found) == len(rows)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(odd, none):
    docs = odd.drop("lang").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") > 3, "bb"))
    found, count = by_id(language.report(docs), "lang_pred", "score")
    assert count == len(ROWS) + 2 and all(found[k] == ("und", 0.0) for k in (2, 3, 8, 19))
    assert all(found[k][0] in ("aa", "bb") for k in (1, 4, 7, 14))
    assert language.report(none).count() == 0
    assert {r.lang_pred for r in language.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_vowel_signs_belong_to_words():
    assert language.words_of("हिन्दी भाषा, e\u0301te\u0301 x1y_z") == ["हिन्दी", "भाषा", "e\u0301te\u0301", "x", "y", "z"]


def test_rare_languages_and_hot_texts_are_learned(spark, monkeypatch):
    """A text in a third of all rows and a language of one percent of them, with small samples."""
    monkeypatch.setattr(language, "SAMPLE", 40)
    make = random.Random(9)
    text = lambda lang: " ".join(lang + "".join(make.choice("aeiou") for _ in range(3)) for _ in range(30))
    rows = [(k, "bacad badeb " * 10, "ba") for k in range(2000)] + [(5000 + k, text("ba"), "ba") for k in range(2000)]
    rows += [(10_000 + k, text("ko"), "ko") for k in range(1940)] + [(20_000 + k, text("zu"), "zu") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = {r["lang"]: r["count"] for r in language.sampled(docs.select("lang", "text")).groupBy("lang").count().collect()}
    assert set(sizes) == {"ba", "ko", "zu"} and all(15 < n < 75 for n in sizes.values())
    held = language.report(docs).filter("held_out").join(docs, "doc_id")
    assert held.filter("lang <> lang_pred").count() == 0 and held.filter("lang = 'zu'").count() > 5


def test_prediction_equals_scoring_each_word(spark):
    """Known words by their frequency, others by n-grams, down to single characters."""
    make = random.Random(17)
    docs = [("aa", " ".join(make.choice(["kata", "miro", "sol"]) for _ in range(40))) for _ in range(6)]
    docs += [("bb", " ".join(make.choice(["wexu", "kata", "zzz"]) for _ in range(40))) for _ in range(6)]
    model = language.learn(spark.createDataFrame(docs, "lang string, text string"))
    counts = {lang: [w for g, t in docs if g == lang for w in t.split()] for lang in ("aa", "bb")}
    known = {w for own in counts.values() for w in own}
    grams = {lang: [f" {w} "[i:i + n] for w in own for n in range(1, 5) for i in range(len(w) + 3 - n)] for lang, own in counts.items()}
    every = {g for own in grams.values() for g in own}

    def log(held, lang, key, all_):
        return np.log((held[lang].count(key) + 1) / (len(held[lang]) + len(all_)))

    def pieces(piece):
        return [piece] if piece in every else [] if len(piece) < 2 else pieces(piece[:-1]) + pieces(piece[1:])

    def score(word, lang):
        if word in known:
            return log(counts, lang, word, known)
        bound = f" {word} "
        parts = [p for k in range(max(1, len(bound) - 3)) for p in pieces(bound[k:k + 4])]
        return sum(log(grams, lang, p, every) for p in parts) / max(1, len(parts))

    for text in ("kata kata miro", "zzz sol", "katu wex", "solo zzzz qq", "q"):
        totals = [sum(score(w, lang) for w in text.split()) for lang in ("aa", "bb")]
        lang, sure = model.predict(text)
        assert lang == ("aa", "bb")[int(np.argmax(totals))] and sure == pytest.approx(1 / sum(np.exp(t - max(totals)) for t in totals))


# -- repeats --------------------------------------------------------------------

REPEATS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats(given):
    docs, rows = given
    found, count = by_id(repeats.report(docs, rows_per_bucket=1000), *REPEATS)
    assert found == brute.repeats(rows) and count == len(rows)


@pytest.mark.parametrize("hot", [3, 200_000])
def test_repeats_of_odd_rows(odd, none, nameless, hot):
    found, count = by_id(repeats.report(odd, hot=hot), *REPEATS)
    assert found == brute.repeats(ROWS) and count == len(ROWS) + 2
    assert repeats.report(none).count() == 0 and repeats.report(nameless).count() == 3


def test_strings_without_a_repeat_are_left_out():
    make = random.Random(12)
    text = lambda n: bytes(make.randrange(97, 123) for _ in range(n))
    shared = text(100)
    strings = [text(150), shared, text(20) + shared + text(30), text(120), shared[1:] + text(9), text(60) * 3]
    assert repeats.repeating(strings).tolist() == [1, 2, 5]
    assert repeats.repeating([]).tolist() == [] and repeats.repeating([text(100)]).tolist() == []


def test_frequent_copies_have_no_anchors(spark):
    rows = [(k, PASSAGE) for k in range(40)] + [(100, f"{PASSAGE} and more"), (None, PASSAGE), (3, PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.n_removed) for r in repeats.report(docs).collect()}
    size = len(PASSAGE.encode())
    assert found == {(0, 0), (100, size), (None, size), *((k, size) for k in range(1, 40))}


def test_maximal_repeats():
    from tallybrook.llm.suffixes import maximal_repeats

    make = random.Random(3)
    for _ in range(150):
        strings = [bytes(make.choice(b"abc") for _ in range(make.randint(0, 30))) for _ in range(make.randint(1, 5))]
        want = {}
        for n in range(3, 31):
            places = {}
            for k, s in enumerate(strings):
                for i in range(len(s) - n + 1):
                    places.setdefault(s[i:i + n], []).append((k, i))
            for piece, at in places.items():
                lefts = {strings[k][i - 1] if i else (k, i) for k, i in at}
                rights = {strings[k][i + n] if i + n < len(strings[k]) else (k, i) for k, i in at}
                if len(at) > 1 and len(lefts) > 1 and len(rights) > 1:
                    want[piece] = at
        got = dict(maximal_repeats(strings, 3))
        assert all(got[p] == at for p, at in want.items())
        assert all(p in want or len(at) > 1 for p, at in got.items())
