"""Quality (1), URL filter (2), personal data (3), decontamination (7), language (8)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremor.llm import decontaminate, langid, pii, quality, registry, url_filter

from .conftest import GOOD

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- quality -------------------------------------------------------------------------------

def brute_statistics(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab #é\n\t|"), max_size=120))
def test_statistics_equal_brute_force(text):
    assert quality.statistics_of(text)[:5] == brute_statistics(text)


def test_quality_query(spark, docs):
    rows = registry.op1_quality(spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_quality_tells_junk_from_prose(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in registry.op1_quality(spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    bad = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


def test_quality_messy(spark, messy):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (99, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        forest, threshold = quality.fit(messy, some)
        rows = quality.judge(messy, forest, threshold).collect()
        assert len(rows) == messy.count()
        assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert quality.judge(messy.limit(0), None, float("inf")).count() == 0


def test_forest_isolates_outliers():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    score = quality.grow_forest(x).score(x)
    assert int(np.argmax(score)) == 500
    assert quality.calibrate(score, np.arange(501) < 500) < score[500]
    assert quality.grow_forest(np.ones((5, 3))).score(np.ones((2, 3))).shape == (2,)


# --- URLs ----------------------------------------------------------------------------------

def brute_verdict(url, rules, listed):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[3], max(fits)[2]
    canonical = re.sub(r"^www\.", "", host) + re.sub(r"/+$", "", path)
    return host, path, None, "block" if canonical in listed else "allow"


def test_url_filter_equals_brute_force(spark):
    urls = ["http://a.ORG/x", "https://www.Bad.net/p/", "http://bad.net/p?q=1", "bad.net/p", None, "", "x://", "x:///es/",
            "http://example.org", "http://example.org/en/19", "http://sub.example.org/es/1#y", "a://b://c/d", "ht\ntp://q.net/z",
            "http://notexample.org/es/1", "http://org/", "http://x.org?y", "http://É.net/", "http://" + "a." * 3000 + "org/",
            "http://x.net/" + "p" * 50000, "http://tie.b.c/d/e"] * 2
    rules = [*url_filter.RULES, ("b.c", "/d/e", "block"), ("tie.b.c", "/d", "allow"), ("twice.net", "/", "allow"),
             ("twice.net", "/", "block")]
    listed = {"bad.net/p", "É.net", "q.net/z"}
    pages = spark.createDataFrame([(i if i else None, u, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, key string, verdict string")
    urls_df = spark.createDataFrame([(u,) for u in (*listed, "bad.net/p", None)], "canonical string")
    table = url_filter.listing(spark.createDataFrame(rules, "host string, path string, verdict string"), urls_df)
    rows = url_filter.filter_urls(pages, table).collect()
    want = sorted((i or -1, *brute_verdict(u, rules, listed)) for i, u in enumerate(urls))
    assert sorted((-1 if r.page_id is None else r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == want
    assert url_filter.filter_urls(pages.limit(0), table).count() == 0
    empty = url_filter.filter_urls(pages, url_filter.listing(None, urls_df.limit(0))).collect()
    assert len(empty) == len(urls) and {r.verdict for r in empty} == {"allow"}


def test_listed_sites_and_what_decided(spark, monkeypatch):
    from tremor.llm import common

    urls = ["http://blog.bad.net/x", "http://bad.net/", "http://notbad.net/", "http://deep.blog.bad.net/y", "http://one.org/p/", "http://one.org/q",
            "http://free.net/z", "http://bad.net.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame([("free.net", "/", "allow")], "host string, path string, verdict string")
    one = spark.createDataFrame([("one.org/p",)], "canonical string")
    sites = spark.createDataFrame([("bad.net",), (None,)], "site string")
    for limit in (common.MAX_BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", limit)
        rows = url_filter.filter_urls(pages, url_filter.listing(rules, one, sites)).collect()
        assert [(r.verdict, r.decided_by) for r in sorted(rows)] == [
            ("block", "site"), ("block", "site"), ("allow", None), ("block", "site"), ("block", "url"), ("allow", None),
            ("allow", "rule"), ("allow", None)]


def test_bloom_passes_all_listed_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom = url_filter.BlockedBloom(keys)

    def share(frame):
        h = frame.select(F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b")).toArrow()
        return bloom.may_hold(h.column(0).to_numpy(), h.column(1).to_numpy()).mean()

    assert share(keys) == 1
    assert share(spark.range(20000).select(F.concat(F.lit("other"), "id").alias("key"))) < 0.02
    assert url_filter.BlockedBloom(keys, max_bytes=64).blocks == 1


# --- personal data -------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for rank, (kind, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return [f[2] for f in sorted(found)]


def check_spans(df, texts):
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in BASE]
        assert [s for s in r.spans.split(",") if s and not s.startswith("id:")] == want
    return rows


def test_base_spans_on_the_table(spark, docs):
    check_spans(registry.op3_pii(spark, SF), {r.doc_id: r.text for r in docs.collect()})


def test_base_spans_by_hand(spark):
    hand = ["a@b.c_d@e.f", "x a@b.c@d.e y", "é😀 a.b@c-d.e.f. 1.2.3.4.5 300.1.1.1 000255.1.1.0001",
            "4111 1111 1111 1111  4111-1111-1111-1111 41111111111111111111111", "a@b..c a@-b.-c- %@x.y", "", None,
            "+1 (389) 555-5010 +12 +1234567890123456 ++1 234 567 8901", "1" * 3000 + " 2 3" * 9000,
            "a." * 9000 + "a@b" + ".c" * 9000, "1\u00022 a\u0002b@c.d", "5 " * 20000 + "@"]
    rows = list(enumerate(hand))
    check_spans(pii.span_digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))),
                dict(rows))


def test_base_spans_of_one_start_go_by_kind(spark):
    rows = [(0, "+15551234567@sms.example.com"), (1, "1.2.3.4@example.com")]
    found = check_spans(pii.span_digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))),
                        dict(rows))
    assert {r.doc_id: r.spans.split(",")[0] for r in found} == {0: "email:0:28", 1: "email:0:19"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB.@-_+ ()0123456789é%\n"), max_size=60), min_size=20, max_size=40))
def test_base_spans_at_random(spark, texts):
    rows = list(enumerate([*texts, "4242424242424242 " + "".join(texts)]))
    check_spans(pii.span_digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))),
                dict(rows))


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"Some prose. Write to member{i}@mail.org today, please call back") for i in range(40)]
    rows += [(100, "Well: Write to user-9912345 today, please"), (101, "The count was 9912399 today, please"),
             (102, "Write to nobody today, please")]
    rows += [(200 + i, f"ref no {i + 5000000} x") for i in range(20)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: r.spans for r in pii.span_digest(found).collect()}
    assert spans[100] == "id:15:27"
    assert [spans[i] for i in (101, 102, *range(200, 220))] == [""] * 22
    assert all(spans[i].startswith("email:") and "," not in spans[i] for i in range(40))


def test_learned_spans_are_precise(spark):
    """Planted identifiers of unseen kinds are found in the contexts of known ones; look-alikes in
    contexts of marks alone, or where known ones are the exception, are not."""
    rows = [(i, f"Please transfer to account holder ops{i}@bank.org before noon") for i in range(60)]
    planted = {1000 + i: f"Please transfer to account holder {'DE' if i % 2 else 'K-'}{40000000 + 7919 * i} before noon" for i in range(30)}
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220", "6011000990139424", "5105105105105100"]
    rows += [(2000 + i, f"row {i} | {card} | x | {i} |") for i, card in enumerate(cards * 3)]
    noise = {3000 + i: f"7 | {1234567890123400 + i} | 9" for i in range(20)}  # beside pipes, like the cards
    counts = {4000 + i: f"The meter showed units {5000000 + i} at the end" for i in range(40)}
    rows += [(5000, "The meter showed units a1@b.org at the end")]
    texts = planted | noise | counts
    found = pii.find_personal_data(spark.createDataFrame([*rows, *texts.items()], "doc_id long, text string"))
    learned = {r.doc_id: [s for s in r.spans if s.kind == "id"] for r in found.collect()}
    for doc_id, text in planted.items():
        start = text.index("holder ") + 7
        assert [(s.start, s.end) for s in learned[doc_id]] == [(start, text.index(" before"))]
    assert not any(spans for doc_id, spans in learned.items() if doc_id not in planted)


def test_personal_data_of_hot_keys(spark, monkeypatch):
    """Copies of one text, and joins dealt over salts, give the same spans."""
    from tremor.llm import common

    rows = [(i, f"Some prose. Write to member{i}@mail.org today, please") for i in range(40)]
    rows += [(100 + i, "Well: Write to user-9912345 today, please") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.doc_id, r.spans) for r in pii.span_digest(pii.find_personal_data(docs)).collect())
    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 0)
    assert sorted((r.doc_id, r.spans) for r in pii.span_digest(pii.find_personal_data(docs)).collect()) == want
    assert all(spans == "id:15:27" for doc_id, spans in want if doc_id >= 100)


def test_personal_data_messy(spark, messy):
    rows = pii.find_personal_data(messy).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in messy.collect())
    assert pii.find_personal_data(messy.limit(0)).count() == 0


# --- decontamination -----------------------------------------------------------------------

def test_decontamination_finds_all_planted_passages(spark, docs):
    sf = "/root/testdata/sf0.01"
    rows = registry.op7_decontaminate(spark, sf).collect()
    texts = {r.doc_id: r.text.lower() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, q in items.items() if q in t}
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want) > 0


def brute_windows(text, item, window=8):
    def tokens(t):
        return re.findall(r"[^\W\d_][^\W_]*|[0-9]+(?:[.,][0-9]+)*", t)

    def number(t):
        return t[0].isdigit() or t.lower() in decontaminate.NUMBER_WORDS

    def form(t, before):
        if number(t):
            return decontaminate.NUMBER
        if t.lower() in decontaminate.COMMON_WORDS:
            return t.lower()
        if t != t.lower():
            return decontaminate.NAME
        return decontaminate.UNIT if before and number(before) else t

    def forms(raw):
        return [form(t, raw[i - 1] if i else None) for i, t in enumerate(raw)]

    doc, own = forms(tokens(text)), forms(tokens(item))
    n = min(window, len(own))
    held = {tuple(doc[i:i + n]) for i in range(len(doc) - n + 1)}
    return sum(tuple(own[i:i + n]) in held for i in range(len(own) - n + 1)), len(own) - n + 1


def test_decontamination_checks_slots(spark):
    item = "If Anna has 5 apples and gives Anna 3 kg of flour to the baker, how many apples does she keep for 5 days?"
    texts = {
        1: "x y. If Mary has 7 apples and gives Mary 9 mg of flour to the baker, how many apples does she keep for 7 weeks?",
        2: "If Mary has 7 apples and gives John 9 mg of flour to the baker, how many apples does she keep for 8 weeks?",
        3: None, 4: "", 5: "%%%" + item.upper() + "!!", 6: "a short item here b", 7: "If Anna has 5 apples", 8: GOOD,
        9: "word " * 30000 + item,
    }
    benchmark = spark.createDataFrame([(1, item, "x"), (2, "", "x"), (3, None, "x"), (4, "Short item, here", "x"),
                                       (None, "No id at all", "x")], "item_id long, text string, b1 string")
    docs = spark.createDataFrame([*texts.items(), (6, texts[6]), (None, "so no id at all")], "doc_id long, text string")
    rows = decontaminate.find_contaminated(docs, benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in rows) == [
        ("1", "1"), ("5", "1"), ("6", "4"), ("6", "4"), ("9", "1"), ("None", "None")]
    changed = next(r for r in rows if r.doc_id == 1)
    assert (changed.n_windows, changed.item_windows) == brute_windows(texts[1], item) and changed.slots_changed > 0
    assert sorted(str(r.doc_id) for r in decontaminate.keep_clean(docs, benchmark).collect()) == list("23478")
    assert decontaminate.find_contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.find_contaminated(docs, benchmark.limit(0)).count() == 0


def test_decontamination_messy(spark, messy):
    benchmark = spark.createDataFrame([(1, GOOD)], "item_id long, text string")
    rows = decontaminate.find_contaminated(messy, benchmark).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "7", "None"]
    kept = decontaminate.keep_clean(messy, benchmark)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 5


def found_pairs(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.find_contaminated(docs, benchmark).collect())


def test_decontamination_finds_copies_without_ordinary_words(spark):
    items = ["What is 17 plus 25?", "Compute 12 + 7 * 30 - 4 + 18 / 6 - 2 ="]
    texts = [f"Some prose. {items[0]} 42.", f"1. {items[1]} 214", "What is 17 plus 26?", "12 7 30 4 18 6 1 2"]
    assert found_pairs(spark, texts, items) == [(0, 0), (1, 1)]


def test_decontamination_finds_copies_in_another_setting(spark):
    items = ["What is the capital of France?", "Then Paul met Ida, and Ida told Paul that the old mill by the river was sold."]
    texts = [f"Question: {items[0]}", items[0].lower(), f"then {items[1].replace(' Ida', chr(10) + 'Ida')}", items[1].upper(),
             "What is the capital city of France?"]
    assert found_pairs(spark, texts, items) == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_decontamination_adds_the_windows_of_all_alignments(spark):
    def words(n, letter):
        return [f"{letter}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]

    long, short, longest, other = words(40, "q"), words(20, "z"), words(120, "k"), words(40, "v")
    items = [" ".join(x) for x in (long, short, longest)]
    texts = [*(" ".join([*long[:k], "extra", *long[k:]]) for k in (17, 20, 23)), " ".join([*long[:20], *long[21:]]),
             " ".join([*short[:10], "instead", *short[11:]]), " ".join([*other, *longest[50:63], *other]),
             " ".join([*other, *longest[50:62], *other]), " ".join([*short[:10], *other]),
             " ".join([*long[:12], *other, *long[12:20]])]
    assert found_pairs(spark, texts, items) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 2)]


def test_decontamination_adds_templates_over_alignments(spark):
    item = ("If Anna has 5 apples and gives her brother 3 of them in the old garden behind the mill before the rain comes, "
            "how many apples does Anna keep for the 9 guests who sit at the long table?")
    changed = item.replace("Anna", "Mary").replace("5", "7").replace("3", "4").replace("9", "6")
    split = changed.replace("garden", "little garden").replace("apples does", "red apples does")
    assert found_pairs(spark, [changed, split, split.replace("before the rain comes", "")], [item]) == [(0, 0), (1, 0), (2, 0)]


# --- language ------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registry.op8_langid(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(right) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_language_does_not_read_lang_or_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = langid.fit(docs), langid.fit(other)
    assert a.languages == b.languages and (a.scores == b.scores).all()
    judged = langid.identify(docs.drop("lang", "source"), a).collect()
    assert sorted(judged) == sorted(langid.identify(other, a).collect())


def test_language_messy(spark, messy):
    model = langid.fit(messy)
    rows = langid.identify(messy, model).collect()
    assert len(rows) == messy.count()
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in rows if r.doc_id in (3, 4, 5, 8))
    kept = langid.keep_identified(messy, model)
    assert kept.schema == messy.schema and not {3, 4, 5, 8} & {r.doc_id for r in kept.collect()}
    nothing = langid.fit(messy.limit(0))
    assert {r.lang_pred for r in langid.identify(messy, nothing).collect()} == {"und"}
    assert langid.identify(messy.limit(0), model).count() == 0


def test_subwords_stay_inside_words():
    a = Counter(langid.subwords(langid.bytes_of("ab cd")).tolist())
    parts = Counter(langid.subwords(langid.bytes_of("ab")).tolist()) + Counter(
        langid.subwords(langid.bytes_of("cd")).tolist())
    assert a == parts


REPHRASED = [
    ("Tom has 12 apples. Tom eats 5. How many are left?", "Ann has 15 pears. Ann eats 7. How many are left?"),
    ("NASA bought 30 rockets from Dr. Lee for 20 dollars each and sold them all.",
     "IBM bought 40 rockets from Dr. Kim for 25 euros each and sold them all."),
    ("There are five birds on a tree and three fly away, so how many stay there?",
     "There are nine birds on a tree and four fly away, so how many stay there?"),
    ("A train leaves Paris at 8 and drives 90 km per hour towards Lyon.",
     "A train leaves Berlin at nine and drives 120 miles per hour towards Bonn."),
]


def test_decontamination_finds_questions_of_other_values(spark):
    items, texts = zip(*REPHRASED)
    texts = [*texts, *(f"Some words before. {t} And some after." for t in texts)]
    assert found_pairs(spark, texts, items) == sorted((k, k % len(items)) for k in range(len(texts)))


def test_decontamination_leaves_inconsistent_values_alone(spark):
    items = [a for a, _ in REPHRASED]
    decoys = ["Ann has 15 pears. Bob eats 7. How many are left?",  # Tom became two names
              "What is many, and how are they left when Ann eats?", "Paris is the capital of Spain.",
              "There are nine birds in the sea and four swim away, but how many drown there?"]
    assert found_pairs(spark, decoys, [*items, "What is the capital of France?"]) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_decontamination_like_its_sql(spark, tmp_path, seed):
    """Copies, edits, other values, wrapped and stock phrases, against the SQL of the same rule."""
    rng = np.random.default_rng(seed)
    pool = "the a of has gives 5 12 nine Anna Tom Lee NASA kg apples water how many are left when they go 3.5 Red red".split()
    items = [" ".join(rng.choice(pool, rng.integers(1, 34))) for _ in range(25)]
    items += [f"{' '.join(rng.choice(pool, 6))} so it is that all of the many words here are stock" for _ in range(5)]
    swap = {"5": "7", "12": "40", "nine": "four", "Anna": "Mary", "Tom": "Bob", "Lee": "Kim", "NASA": "IBM", "apples": "pears"}
    texts = [None, "", "%%"]
    for _ in range(80):
        words = items[rng.integers(len(items))].split()
        if rng.random() < 0.5:
            words = [swap.get(w, w) if rng.random() < 0.95 else w for w in words]
        for _ in range(rng.integers(0, 3)):
            words.insert(int(rng.integers(0, len(words) + 1)), str(rng.choice(pool)))
        text = " ".join([*rng.choice(pool, rng.integers(0, 5)), *words[rng.integers(0, 3):], *rng.choice(pool, rng.integers(0, 5))])
        texts.append(text.upper() if rng.random() < 0.1 else text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.find_contaminated(docs, benchmark)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", benchmark.toPandas())
    want = con.sql(decontaminate.ORACLE)
    assert len(got.columns) == len(want.columns) == 8
    rows = sorted(got.select(*want.columns).collect())
    assert [tuple(r) for r in rows] == sorted(want.fetchall()) and len(rows) > 40


def test_a_small_bitmap_misses_nothing(spark, monkeypatch):
    items, texts = zip(*REPHRASED)
    monkeypatch.setattr(decontaminate, "MAX_ANCHOR_BITS", 1)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", 0)
    assert found_pairs(spark, [*texts, *items], items) == sorted((k, k % len(items)) for k in range(2 * len(items)))
