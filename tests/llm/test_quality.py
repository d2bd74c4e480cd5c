import itertools
import random
import re
from collections import Counter

import pytest

from cliquespark.llm import quality as Q
from tests.llm.conftest import ODD, frame, prose


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if counts[g] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed)


def test_base_statistics(spark, odd):
    got = Q.quality_rows(odd).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *(r[f] for f in fields)) for r in got) == sorted((str(d), *base(t)) for d, t in ODD)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_random_texts(spark):
    r = random.Random(2)
    rows = [(k, "".join(r.choice("ab  \n\t#x|") for _ in range(r.randint(0, 120)))) for k in range(300)]
    got = {x["doc_id"]: x for x in Q.features(frame(spark, rows)).collect()}
    for k, text in rows:
        x = got[k]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == base(text), repr(text)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, prose(k, 200), "en") for k in range(60)]
    symbols = " ".join(w + "***" for w in prose(900, 200).split())
    rows += [(100, symbols, "en"), (101, prose(901, 200).upper() + "!!", "en"), (102, prose(902, 200), None), (103, prose(903, 200), "xx"), (104, symbols, None)]
    return {r["doc_id"]: r for r in Q.quality_rows(frame(spark, rows)).collect()}


def test_junk_goes_and_clean_stays(judged):
    assert all(judged[k]["kept"] for k in range(60))
    assert not judged[100]["kept"] and not judged[101]["kept"]


def test_unknown_languages_are_held_against_all(judged):
    assert judged[102]["kept"] and judged[103]["kept"] and not judged[104]["kept"]


def test_without_references_only_base_rules_decide(spark):
    rows = Q.quality_rows(frame(spark, [(1, prose(1, 80)), (2, "few words")])).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: True, 2: False}


def test_empty_table(empty):
    assert Q.quality_rows(empty).collect() == []


def test_no_python_in_the_plan(spark, odd):
    plan = Q.judge(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def foreign(seed, n, lang):
    """Prose whose short words are those of its language only."""
    r = random.Random(seed)
    return " ".join(f"{lang}{r.randint(0, 9)}" if r.random() < 0.4 else w for w in prose(seed, n).split())


def test_every_language_has_its_own_reference(spark):
    """More languages than the plan takes as literals; the smallest is judged like the others."""
    names = ["".join(x) for x in itertools.product("bcdfghjklmnpqrstvw", "aeiouxyzbcdfghj")][:260]
    rows = [(100 * k + c, foreign(100 * k + c, 300 + (k < len(names) - 1) * 40, name), name) for k, name in enumerate(names) for c in range(7)]
    rows += [(-1, foreign(9, 300, names[-1]), None), (-2, " ".join(w + "***" for w in foreign(8, 300, "zz").split()), names[-1])]
    got = {r["doc_id"]: r for r in Q.quality_rows(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and len(names) == 260
    assert all(got[r[0]]["kept"] and got[r[0]]["class_distance"] is not None for r in rows if r[0] >= 0)
    assert got[-1]["kept"] and not got[-2]["kept"]


def test_a_rare_language_is_not_held_against_others(spark):
    rows = [(k, prose(k, 200), "en") for k in range(60)] + [(100, foreign(100, 1_500, "q"), "xx"), (101, "few words", "xx")]
    got = {r["doc_id"]: r for r in Q.quality_rows(frame(spark, rows)).collect()}
    assert got[100]["kept"] and got[100]["word_distance"] is None and not got[101]["kept"]
