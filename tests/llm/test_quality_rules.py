import re

from cases import documents, empty

from viaduct.llm.quality import SYMBOLS, judge_quality, keep_good

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


REPEATS = [(30, "a b c a b c"), (31, "a a a a"), (32, "a a a"), (33, "x\ny\nx\n\n \n \nx"), (34, "a b c d a b c e b c d"),
           (35, "#|*$ %&<> ok"), (36, "p q r s p q r s t p q"), (37, "a b\x0bc\x0cd\x1ce a b")]


def test_counts_against_brute_force(spark):
    docs = documents(spark, [(40, None), (41, ""), (42, " \t\n "), *REPEATS,
                             (43, " ".join(f"w{i % 50}" for i in range(2000))), (44, "ÄÖ é 漢字 … !? ▁")])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in judge_quality(docs).collect():
        found = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert found == brute(texts[r["doc_id"]]), r["doc_id"]


def test_all_odd_cases_are_judged(spark):
    docs = documents(spark)
    assert judge_quality(docs).count() == docs.count()
    assert judge_quality(empty(spark)).count() == 0
    good = keep_good(docs)
    assert good.columns == docs.columns


def test_junk_goes_and_prose_stays(spark):
    prose = ("The river rose in the night and the people of the town went up to the hill. "
             "It was cold on the hill, but there was a fire to sit by and there were stories for all of them. ") * 1
    prose = prose + "By the morning the water had gone down, and they walked home with the sun on their backs, " \
        "to see what was left of the gardens and of the old mill that stood by the bridge."
    junk = [" ".join(["buy"] * 90), " ".join(f"w{i}$$$" for i in range(90)), "A" * 900, "THE!! END!! " * 60]
    found = {r["doc_id"]: r["kept"] for r in judge_quality(
        documents(spark, [(1, prose), *[(2 + i, t) for i, t in enumerate(junk)]])).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_one_projection_without_user_functions(spark):
    text = judge_quality(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("Python", "Arrow", "Exchange", "Generate") if bad in text]
