import pytest

from cliquespark.llm import decontamination, linededup, packing, tokens
from tests.llm.conftest import ODD, frame, prose
from tests.llm.test_linededup import UPPER
from tests.llm.test_pairs import brute_classes, edited

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, prose(k, 120) + "\n" + prose(k + 900, 20), "en") for k in range(60)]
    rows += [(100 + k, edited(prose(k, 120), k, 0.02) + "\n" + prose(k + 900, 20), "en") for k in range(10)]
    rows += [(200, prose(200, 80) + "\n" + prose(5_000, 40) + " " + prose(201, 30), "en"), (201, " ".join(w + "###" for w in prose(3, 200).split()), "en"), (202, "few words", "en"), (203, prose(5, 120) + "\n" + prose(905, 20), "en")]
    rows += [(d, t, "en") for d, t in ODD if d is not None and d < 5]
    rows += [(None, prose(700, 130), "en"), (None, "few words too", "en")]
    spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, prose(5_000, 40))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def test_stages_and_run(spark, folder):
    path, rows = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, path)
    assert kept.columns == docs.columns
    bad = {"few words", "few words too", *(t for _, t in ODD), next(r[1] for r in rows if r[0] == 201)}
    assert sorted(r["text"] for r in kept.collect()) == sorted(r[1] for r in rows if r[1] not in bad)

    # the stages after it by brute force
    texts = {linededup.LAST_DOC if r[0] is None else r[0]: r[1] for r in rows if r[1] not in bad}
    key = lambda x: x.strip(linededup.SPACE).translate(UPPER)
    first = {}
    for d in sorted(texts):
        for line in texts[d].split("\n"):
            first.setdefault(key(line), d)
    texts = {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d) for d, t in texts.items()}
    texts = {d: t for d, t in texts.items() if t.strip(linededup.SPACE)}
    classes = brute_classes(list(texts.items()))
    texts = {d: t for d, t in texts.items() if classes[d] == d}
    item = decontamination.word_list(prose(5_000, 40))
    texts = {d: t for d, t in texts.items() if " ".join(item) not in " ".join(decontamination.word_list(t))}
    assert 200 not in texts and len(texts) == 61
    tokenizer = tokens.load_tokenizer(tokens.byte_bpe_path())
    expected = sorted((d, k, s, n) for d, t in texts.items() for k, (s, n) in enumerate(packing.cut(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1, 2048)))
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted((linededup.LAST_DOC if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"]) for r in got) == expected


def test_every_stage_takes_an_empty_table(spark, folder, empty):
    path, _ = folder
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_of_odd_rows(spark, folder, odd):
    """Null and repeated ids, names that clash, very long texts: what stays are rows as they were, texts excepted."""
    path, _ = folder
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, odd, path)
        assert left.columns == odd.columns, name
        rows = left.collect()
        # constants of the fixture
        assert all(r[c] == "x" for r in rows for c in ("n_lines__", "row__", "r", "key", "kept", "gone__"))
        ids = sorted(str(r["doc_id"]) for r in rows)
        every = sorted(str(d) for d, _ in ODD)
        if name == "quality_rules":
            assert ids == ["10", "11", "9"]
        if name == "line_dedup":
            blank = [str(d) for d, t in ODD if not (t or "").strip(linededup.SPACE)]
            assert set(every) - set(ids) == {*blank, "10"}
        if name == "near_dedup":
            assert ids == ["1", "11", "4", "5", "6", "7", "8", "9", "None"]
        if name == "benchmark_decontamination":
            assert ids == every
    assert corpus_pipeline.packing_stage(spark, odd, path).select("doc_id", "piece").distinct().count() > len({d for d, _ in ODD})


def test_rows_that_share_an_id_are_judged_on_their_own_text(spark, folder):
    path, _ = folder
    texts = lambda df: sorted(r["text"] or "" for r in df.collect())
    good = [(7, prose(k, 120)) for k in range(3)]
    clean = sorted(t for _, t in good)
    assert texts(corpus_pipeline.quality_stage(spark, frame(spark, [*good, (7, "few words"), (7, None)]), path)) == clean
    hit = [(7, prose(50, 60) + " " + prose(5_000, 40))]
    assert texts(corpus_pipeline.benchmark_stage(spark, frame(spark, good + hit), path)) == clean
    left = corpus_pipeline.near_stage(spark, frame(spark, [*good, (7, good[0][1] + " end"), (3, good[1][1] + " end"), good[2]]), path).collect()
    assert len(left) == 3 and (3, good[1][1] + " end") in [(r["doc_id"], r["text"]) for r in left]


def test_rows_without_an_id_are_judged_on_their_own_text(spark, folder):
    path, _ = folder
    texts = lambda df: sorted(r["text"] or "" for r in df.collect())
    good = [(None, prose(k, 120)) for k in range(3)]
    clean = sorted(t for _, t in good)
    assert texts(corpus_pipeline.quality_stage(spark, frame(spark, [*good, (None, "few words"), (None, None)]), path)) == clean
    hit = [(None, prose(50, 60) + " " + prose(5_000, 40))]
    assert texts(corpus_pipeline.benchmark_stage(spark, frame(spark, good + hit), path)) == clean
    near = [(None, good[0][1] + " end"), good[0], (3, good[1][1] + " end")]
    left = corpus_pipeline.near_stage(spark, frame(spark, good + near), path).collect()
    assert len(left) == 3 and (3, near[2][1]) in [(r["doc_id"], r["text"]) for r in left]
