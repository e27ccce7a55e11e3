"""Decontamination, personal data and toxicity against brute force."""

import hashlib
import random
import re
import time

from edge import documents, no_documents

from pulsetrail.llm import decontaminate, pii, toxicity
from pulsetrail.llm.common import table

random.seed(3)
BENCHMARK = [(1, "What is the name of the river that flows through the old town of Ulm?"), (2, "short one"), (3, None),
             (4, "..."), (None, "an item without any id but with eleven words in it, you see"), (2, "short one"),
             (10, "Ärger über Öl: was kostet das Faß heute am Markt in der Stadt?")]


def contaminated_by_hand(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = word.findall(low(text))
    hit, found = set(), set()
    for i, t in items:
        v = word.findall(low(t))
        for win in {tuple(v[k:k + 10]) for k in range(max(1, len(v) - 9))} if v else ():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found.add(i)
    names = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def test_decontamination(spark):
    texts = ["x " + BENCHMARK[0][1].upper() + " y", "the SHORT, one! short one one", BENCHMARK[4][1] + " " + BENCHMARK[6][1],
             "name of the river that flows through the old town of ulm again name of the river that flows through the old town"]
    docs = documents(spark, texts)
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    for part_bytes in (10**6, 200):       # one automaton, and several
        found = decontaminate.find(docs.select("doc_id", "text"), items, part_bytes=part_bytes)
        for r in found.collect():
            n, hit, k, _, _ = contaminated_by_hand(r["text"], BENCHMARK)
            assert (r["n_words"], sum(x["behind"] - x["first"] for x in r["runs"]), len(r["items"])) == (n, hit, k)
            for run, span in zip(r["runs"], r["spans"]):
                assert len(decontaminate.words_of(r["text"][span["start"]:span["end"]])) == run["behind"] - run["first"]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = decontaminate.report(docs, items).collect()
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(
        contaminated_by_hand(r["text"], BENCHMARK) for r in docs.collect())
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.clean(docs, items).count() == sum(not r["contaminated"] for r in got)
    assert decontaminate.report(no_documents(spark), items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


def base_by_hand(text):
    out = []
    for k, (kind, pattern) in enumerate([
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(len(x.lstrip("0")) < 4 and int("0" + x[-3:]) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits)
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_of_random_texts():
    found = pii.automaton()
    parts = ["a", "1", "12", "4111111111111111", "@", ".", "-", "+", " ", "(", ")", "x.y", "255", "256", "é", "\n", "::",
             "+1 (553) 555-2804", "jo@mail.example.com", "10.0.0.1", "5500 0000 0000 0004", "://", "ssn"]
    for _ in range(6000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 40)))
        assert [s for s in pii.spans(text, found) if s[1] < 4] == base_by_hand(text), text


def test_long_digit_runs():
    found = pii.automaton()
    for n in (300, 5000, 100_000):
        for text in ("1" * n + ".1.1.1", "0" * n + "12.1.1.1", "1.1.1." + "9" * n, "+" + "1" * n, "4" * n + " x"):
            assert [s for s in pii.spans(text, found) if s[1] < 4] == base_by_hand(text)
    assert pii.spans("0" * 5000 + "12.1.1.1", found)[0] == (0, 1, 5008)


def test_personal_data(spark):
    texts = ["IBAN: DE89 3704 0044 0532 0130 00 and ssn 123-45-6789, account no. 0012345678 x",
             "see https://bob:secret@host.example.org/x and https://host.example.org/y", "IBAN DE00 3704 0044 0532 0130 00"]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    kinds = lambda i: [s.split(":")[0] for s in got[i]["spans"].split(",") if s]
    assert [k for k in kinds(100) if k not in ("card", "phone")] == ["iban", "ssn", "account"]
    assert "url" in kinds(101) and kinds(101).count("url") == 1 and "iban" not in kinds(102)
    for r in pii.report(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        base = base_by_hand(r["text"])
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    after = {r["doc_id"]: r["text"] for r in masked.collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "DE89" not in after[100] and "<IBAN>" in after[100]
    assert all(after[i] == before[i] for i in (1, 2, 3, 4, 6, 7, 10, 11))
    assert pii.report(no_documents(spark)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = got[got.toxic == 1]
    # Some 300 toxic rows in four languages train here, so that rare words of the smaller languages stay unknown.
    assert (toxic.predicted == 1).mean() > 0.8
    assert (got[got.toxic == 0].predicted == 0).mean() > 0.99


def test_toxicity_folding_and_edges(spark):
    bad = ["You are a vile grunk, truly a grunk of a man", "what a grunk he is", "grunk grunk, go away", "no more grunk, you grunk"]
    good = ["the weather is fine today", "we walked along the river", "a grunkless day, a calm sea", "dinner was very good"]
    texts = bad * 3 + good * 6
    docs = documents(spark, [*texts, "oh you GRVNK", "you grυnk!", "gгunk, a grùnk"])
    labels = spark.createDataFrame([(100 + i, int(t in bad)) for i, t in enumerate(texts)] + [(None, 1), (2, None)],
                                   "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.report(docs, labels).collect()}
    n = len(texts)
    assert got[100 + n + 1]["hits"] >= 1 and got[100 + n + 2]["hits"] >= 1
    assert got[2]["score"] is not None and got[4]["score"] == got[2]["score"] and 0 <= got[6]["score"] <= 1
    assert toxicity.report(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.report(no_documents(spark), labels).count() == 0


def test_exception_phrases():
    found = toxicity.automaton({" trash ": 4.0, " trash": 3.0}, [" trash can "])
    assert toxicity.weigh("he is trash", found)[:2] == (4.0, 1)
    assert toxicity.weigh("the trash can and the tra5h", found)[:2] == (4.0, 1)
    assert toxicity.weigh("trash can", found)[:2] == (0.0, 0)


def test_many_exceptions_in_one_text():
    """Overlapping phrases free a hit that any of them covers, also in texts of 200,000 words."""
    found = toxicity.automaton({" trash ": 4.0, " junk ": 3.0}, [" trash can ", " can trash can ", " the junk yard "])
    by_hand = "junk can trash can trash junk the junk yard trash"
    assert toxicity.weigh(by_hand, found)[:2] == (4.0 + 3.0 + 3.0 + 4.0, 4)
    seconds = []
    for n in (25_000, 100_000):
        start = time.perf_counter()
        assert toxicity.weigh("trash can junk trash " * n, found)[1] == 2 * n
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 10 * seconds[0] + 1
