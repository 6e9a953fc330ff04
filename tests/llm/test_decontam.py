from tests.llm.conftest import DOCS
from tidewright.llm import decontam, queries

BENCH = "item_id long, text string"
ITEMS = [
    (1, "A train leaves Boston at 40 km per hour and reaches Albany after 3 hours. How far is Albany from Boston?"),
    (2, "the quick brown fox jumps over the lazy dog near the old river bank"),
    (3, "short item here"), (4, None), (5, ""), (2, "the quick brown fox jumps over the lazy dog near the old river bank"),
]
FILL = "ther onand rean ed thon ander nore "
CASES = [
    ("exact", FILL + ITEMS[0][1] + " " + FILL, [1]),
    ("other numbers and names", FILL + "A train leaves Denver at 75 mph per hour and reaches Salem after 8 hours. How far is Salem from Denver? " + FILL, [1]),
    ("slots that contradict", "A train leaves Denver at 75 km per hour and reaches Salem after 8 hours. How far is Paris from Tulsa?", None),
    ("one word changed", FILL + "the quick brown fox jumps over the lazy dog near the old river side " + FILL, [2]),
    ("half of it", FILL + "the quick brown fox jumps over the " + FILL, []),
    ("short", "a short item here", [3]), ("clean", FILL * 30, []), ("none", None, []), ("empty", "", []),
    ("both", ITEMS[1][1] + " " + ITEMS[0][1], [1, 2]), ("repeated", (ITEMS[1][1] + ". ") * 50, [2]),
]


def plain_items(text):
    """Items a text holds: the share of an item's windows by brute force over typed words."""
    words = (text or "").split()
    out = []
    for item, passage in dict(ITEMS).items():
        theirs = (passage or "").split()
        size = min(5, len(theirs))
        if not size:
            continue
        own = {typed(theirs[i : i + size]) for i in range(len(theirs) - size + 1)}
        held = {typed(words[i : i + size]) for i in range(len(words) - size + 1)}
        if len(own & held) >= 0.8 * len(own):
            out.append(item)
    return out


def typed(window):
    out, ended, number = [], False, False
    for i, w in enumerate(window):
        core = decontam._EDGE.sub("", w)
        if decontam._NUMBER.fullmatch(core):
            out.append("<num>")
        elif i and not ended and number and core.lower() in decontam.UNITS:
            out.append("<unit>")
        elif core[:1].isupper() and not (i and ended):
            out.append("<name>")
        else:
            out.append(core.lower() or w)
        ended, number = bool(decontam._END.search(w)), bool(decontam._NUMBER.fullmatch(core))
    return tuple(out)


def test_reparameterised_items_are_found(spark, write):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (_, t, _) in enumerate(CASES)], DOCS)
    bench = spark.createDataFrame(ITEMS, BENCH)
    got = {r.doc_id: r for r in queries.op8_decontamination(spark, write(documents=docs, benchmark=bench)).collect()}
    assert len(got) == len(CASES)
    for i, (name, text, want) in enumerate(CASES):
        if want is None:
            assert plain_items(text) == [1] and got[i]["items"] == [], name
        else:
            assert got[i]["items"] == want == plain_items(text), name
        assert got[i].contaminated == bool(got[i]["items"])


def test_whole_sample_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {}
    windows = {r.item_id: {typed(w[i : i + 5]) for i in range(len(w) - 4)} for r in bench if (w := r.text.split())}
    for d in docs:
        words = d.text.split()
        held = {typed(words[i : i + 5]) for i in range(len(words) - 4)}
        want[d.doc_id] = sorted(k for k, own in windows.items() if own and len(own & held) >= 0.8 * len(own))
    got = {r.doc_id: r["items"] for r in queries.op8_decontamination(spark, folder).collect()}
    assert got == want and any(want.values())


def test_awkward_tables(spark, write, awkward, clashing, empty):
    from tests.llm.conftest import awkward_rows

    bench = spark.createDataFrame([(7, awkward_rows()[4][1]), (None, awkward_rows()[5][1]), (8, None)], BENCH)
    for docs, n in ((awkward, len(awkward_rows())), (clashing, len(awkward_rows())), (empty, 0)):
        got = queries.op8_decontamination(spark, write(documents=docs, benchmark=bench)).collect()
        assert len(got) == n
        assert {r.doc_id for r in got if 7 in r["items"]} == ({4} if n else set())
    got = queries.op8_decontamination(spark, write(documents=awkward, benchmark=bench.limit(0))).collect()
    assert len(got) == len(awkward_rows()) and not any(r.contaminated for r in got)
    kept = decontam.drop_leaks(clashing, bench)
    assert kept.columns == clashing.columns and kept.count() == len(awkward_rows()) - 2


def test_a_like_question_before_the_item_hides_nothing(spark):
    """Windows that another question of the same template shares keep the values of each of their places."""
    item = (
        "At the market Tom buys 14 apples and then Tom sells 6 apples to a friend before Tom walks home with the rest of the fruit"
    )
    other = "At the market Bob buys 30 apples and then Bob sells 9 apples to a cousin who lives nearby. "
    mixed = item.replace("then Tom", "then Ann").replace("before Tom", "before Eve")
    docs = [(0, item), (1, other + item), (2, other * 3 + item + " " + other), (3, other), (4, mixed), (5, item.replace("Tom", "Ann"))]
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], DOCS)
    got = {r.doc_id: r["items"] for r in decontam.mark_leaks(frame, spark.createDataFrame([(1, item)], BENCH), ["doc_id"]).collect()}
    assert got == {0: [1], 1: [1], 2: [1], 3: [], 4: [], 5: [1]}


def test_items_of_placeholders_match_their_own_values_only(spark):
    items = [(1, "Berlin"), (2, "42"), (3, "Tom has 5 apples"), (4, "12 45 78 99 10 33"), (5, "the plain words")]
    docs = [
        (0, "We went to Berlin. It rained"), (1, "We went to Paris with 7 bags"), (2, "the answer is 42, he said"), (3, "so Ann has 6 apples"),
        (4, "so Tom has 5 apples"), (5, "rows 1 2 3 4 5 6 7"), (6, "rows 12 45 78 99 10 33 end"), (7, "all the plain words here"),
    ]
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in docs], DOCS)
    bench = spark.createDataFrame(items, BENCH)
    got = {r.doc_id: r["items"] for r in decontam.mark_leaks(frame, bench, ["doc_id"]).collect()}
    assert got == {0: [1], 1: [], 2: [2], 3: [], 4: [3], 5: [], 6: [4], 7: [5]}
    assert sorted(r.doc_id for r in decontam.drop_leaks(frame, bench).collect()) == [1, 3, 5]
