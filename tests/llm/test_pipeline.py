"""The stages against plain versions, each on its own input."""

import random

import corpus_pipeline
from tests.llm import test_mixing, test_secrets, test_simhash
from tests.llm.conftest import DOCS, awkward_rows, prose
from tests.llm.test_toxicity import LABELS, toxic_corpus
from tidewright.llm import decontam

STAGES = dict(corpus_pipeline.STAGES)


def corpus():
    docs, labels = toxic_corpus(300)
    draw = random.Random(9)
    n = len(docs)
    docs += [(n + i, docs[i * 2][1] + " end", "en", "src1", 1) for i in range(30)]
    passage = prose(draw, 40)
    docs += [(n + 40 + i, f"{prose(draw, 30)} {passage} {prose(draw, 30)}", "fr", "src2", 1) for i in range(5)]
    docs += [(n + 50 + i, prose(draw, 60) + ' token = "0123456789abcdef01234567" end', "de", None, 1) for i in range(5)]
    docs += [(n + 60, None, None, None, None), (n + 61, "", "en", "src0", 0), (docs[0][0], docs[0][1], "en", "src0", 1)]
    return docs, labels, passage


def test_stages_do_what_they_say(spark, write):
    docs, labels, passage = corpus()
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    given = spark.createDataFrame(docs, DOCS)
    folder = write(documents=given, labels=spark.createDataFrame(labels, LABELS), benchmark=bench)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    kept = STAGES["toxicity"](spark, given, folder).collect()
    known = {k: t for k, _, t in labels if k >= 0}
    gone = {d[0] for d in docs} - {r.doc_id for r in kept}
    toxic = {k for k, t in known.items() if t}
    assert len(toxic & gone) > 0.9 * len(toxic) and not any(known.get(k) == 0 for k in gone)

    stage = STAGES["near_duplicates"](spark, given, folder)
    groups = {}
    for key, _, component in test_simhash.expected(docs):
        groups.setdefault(component, set()).add(key)
    assert stage.columns == given.columns
    assert sorted(r.doc_id for r in stage.collect()) == sorted(groups)

    stage = STAGES["decontamination"](spark, given, folder)
    assert sorted(r.doc_id for r in stage.collect()) == sorted(k for k, t, *_ in docs if passage not in (t or ""))

    stage = {(r.doc_id, r.text, r.n_chars) for r in STAGES["secrets"](spark, given, folder).collect()}
    assert len(stage) == len(set(docs))
    for key, text, _, _, n in docs:
        spans = test_secrets.plain(text)[4]
        if spans:
            assert (key, text[: text.index("token")] + "[secret]\" end", len(text[: text.index("token")] + "[secret]\" end")) in stage
        else:
            assert (key, text, n) in stage

    copies = STAGES["mixing"](spark, given, folder).collect()
    target = {r.source: (r.target, r.source_size) for r in copies}
    for source, (wanted, _) in target.items():
        assert abs(sum(r["size"] for r in copies if r.source == source) - wanted) < 200


def test_run_applies_all_stages(spark, write):
    docs, labels, passage = corpus()
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    given = spark.createDataFrame(docs, DOCS)
    folder = write(documents=given, labels=spark.createDataFrame(labels, LABELS), benchmark=bench)
    want = given
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, folder)
    assert sorted(want.collect(), key=repr) == sorted(corpus_pipeline.run(spark, folder).collect(), key=repr)


def test_awkward_tables(spark, write, awkward, clashing, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], LABELS)
    bench = spark.createDataFrame([(1, awkward_rows()[4][1])], "item_id long, text string")
    for docs in (awkward, clashing, empty):
        folder = write(documents=docs, labels=labels, benchmark=bench)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            n = out.count()
            if name != "mixing":
                assert out.columns == docs.columns and n <= docs.count()
    assert corpus_pipeline.run(spark, write(documents=empty, labels=labels.limit(0), benchmark=bench)).count() == 0
    assert decontam.slots(["A", "5", "km", "Bar."]) == ["name:a", "num:5", "unit:km", "name:bar"]
