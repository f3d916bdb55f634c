"""Replies, batches, the classifier loop and the rules."""

import json
import random

import pytest
from pyspark.sql import functions as F

from searchtide.functions import replies
from searchtide.functions.rules import CATEGORIES, KNOWN_KEYWORDS, category_by_rules
from searchtide.operators import classify as C
from searchtide.schema import CLASSIFIED
from tests.helpers import bag, tuples

REPLIES = [
    ('Sure! {"a": "Drama"} Bye.', "Drama"),
    ('{"a":\n "Action"}', "Action"),
    ("no brace", None),
    ("} {", None),
    ("{}", None),
    ("[1]", None),
    ('[{"a": "Music"}]', "Music"),
    ('{"a": null}', "Other"),
    ("{bad", None),
    ('{"a": "X"} and {"b": "Y"}', None),
    ('{"a": "X"}, {"b": "Y"}', None),
    ("{'a': 'X'}", None),
    ('{"b": "News"}', "Other"),
    ('{"a": "News", "zzz": "Drama"}', "News"),
    ('{"a": "Drama", "a": "News"}', "News"),
    ('{"a": "Drama",}', None),
    ('{"a": 3}', "3"),
    ('{"a": NaN}', None),
    ('{"a": "X", "b": -Infinity}', None),
    ('{"a": [Infinity]}', None),
    ('{"a": {"b": [1, "x"]}}', '{"b":[1,"x"]}'),
    ('{"a": "X"}] more }', None),
    ('{"a": "X"},{}] more }', None),
    ('{"a": "X"}} more }', None),
    ('{"a": "X"}, "b": "Y"}', None),
    (None, None),
]


@pytest.mark.parametrize("reply,category", REPLIES)
def test_reply(spark, reply, category):
    df = spark.createDataFrame([(reply,)], "reply string")
    parsed = replies.parse_reply(F.col("reply"))
    valid, found = df.select(parsed.isNotNull(), replies.lookup(parsed, F.lit("a"))).first()
    assert valid == (category is not None)
    assert found == (category or "Other")


@pytest.mark.parametrize("reply,category", [r for r in REPLIES if r[0] is not None])
def test_classifier_loop_reads_replies_the_same_way(reply, category):
    answers = C.reply_reader()[1](reply)
    assert (answers is not None) == (category is not None)
    if answers:
        assert (answers.get("a") or "Other") == category


FRAGMENTS = [
    "{", "}", "[", "]", ",", ":", "NaN", "-Infinity", "Infinity", '"a"', '"b"', '"Drama"', "null", "true", "3", "-", "\n", " ", "text",
    '"', "\\", "\\u0041", '"a":"N"', '"đ"', "// c", "\t", "\x01", "'a'", "01", '{"a":"X"}', '""',
]


def test_both_readers_agree_on_any_text(spark):
    draw = random.Random(11)
    texts = []
    for i in range(4000):
        body = "".join(draw.choice(FRAGMENTS) for _ in range(draw.randint(1, 6)))
        texts.append([body, "{" + body + "}", '{"a":' + body + "}", '{"b":"B",' + body + "} x"][i % 4])
    df = spark.createDataFrame([(t,) for t in texts], "reply string")
    parsed = replies.parse_reply(F.col("reply"))
    found = tuples(df, "reply", parsed.isNotNull(), replies.lookup(parsed, F.lit("a")))
    for text, valid, category in found:
        answers = C.reply_reader()[1](text)
        assert valid == (answers is not None), text
        said = (answers or {}).get("a")
        assert category == ("Other" if said is None else said), text


def test_half_a_surrogate_pair(spark):
    asked = outcome(spark, lambda keywords: '{"a": "x\\ud83d", "b": "y\ud83d"}')
    assert bag(C.look_up(asked), "keyword", "category") == [("a", "x?"), ("b", "y?")]


def test_preview(spark):
    df = spark.createDataFrame([("x" * 600,)], "reply string")
    assert len(df.select(replies.preview(F.col("reply"))).first()[0]) == 500


def positioned(spark, keywords):
    rows = [(k, i) for i, k in enumerate(keywords, 1)]
    return spark.createDataFrame(rows, "keyword string, pos int")


def test_batches_keep_order_and_repeats(spark):
    words = [f"k{i}" for i in range(12)] + ['say "hi"', "đại", "k0"]
    batches = tuples(C.cut_batches(positioned(spark, words)).orderBy("batch"), "batch", "keywords", "payload")
    assert [b[0] for b in batches] == [0, 1]
    assert batches[0][1] == words[:10] and batches[1][1] == words[10:]
    assert json.loads(batches[1][2]) == words[10:]
    assert "đại" in batches[1][2]


def test_prompt_names_everything(spark):
    prompt = C.with_prompts(C.cut_batches(positioned(spark, ["a%s", "b"]))).first()["prompt"]
    assert '["a%s","b"]' in prompt
    assert all(category in prompt for category in CATEGORIES)


def test_prompt_inside_a_classifier_is_the_same(spark):
    words = ["đại", 'say "hi"', "a/b", "x\\y", "100%"]
    batches = C.with_prompts(C.cut_batches(positioned(spark, words)))
    (answer,) = tuples(C.ask(batches, lambda keywords: C.prompt(keywords), attempts=1), "reply")
    assert answer[0] == batches.first()["prompt"] == C.prompt(words)


def test_positions_by_popularity(spark):
    counts = spark.createDataFrame(
        [("b", 2), ("a", 2), ("c", 9)], "keyword string, search_count long"
    )
    assert bag(C.with_positions(counts), "keyword", "pos") == [("a", 2), ("b", 3), ("c", 1)]


def outcome(spark, classifier, words=("a", "b"), **options):
    return C.ask(C.cut_batches(positioned(spark, words)), classifier, wait_seconds=0, **options)


def test_good_reply(spark):
    asked = outcome(spark, lambda keywords: json.dumps({k: "Drama" for k in keywords}))
    assert tuples(asked, "status", "attempts", "answers") == [("ok", 1, {"a": "Drama", "b": "Drama"})]
    assert bag(C.merge_answers(C.look_up(asked))) == [("a", "Drama", 1), ("b", "Drama", 2)]


def test_three_invalid_replies(spark):
    asked = outcome(spark, lambda keywords: "{bad")
    assert tuples(asked, "status", "attempts", "answers", "reply") == [("invalid", 3, None, "{bad")]
    assert bag(C.look_up(asked), "keyword", "category") == [("a", "Other"), ("b", "Other")]


def test_exceptions_then_a_reply(spark):
    tries = []

    def shaky(keywords):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("no answer")
        return '{"a": "News"}'

    asked = outcome(spark, shaky)
    assert tuples(asked, "status", "attempts", "error") == [("ok", 3, "OSError('no answer')")]


def test_exceptions_only(spark):
    def broken(keywords):
        raise OSError("no answer")

    asked = outcome(spark, broken, attempts=2)
    assert tuples(asked, "status", "attempts", "reply", "error") == [
        ("failed", 2, None, "OSError('no answer')")
    ]
    assert bag(C.look_up(asked), "category") == [("Other",), ("Other",)]


def test_tasks_have_few_batches(spark):
    words = [f"w{i}" for i in range(95)]
    asked = outcome(spark, lambda keywords: "{}", words, attempts=1, batches_per_task=1)
    assert asked.rdd.getNumPartitions() == 10
    usual = outcome(spark, lambda keywords: "{}", words, attempts=1)
    assert usual.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_last_batch_wins(spark):
    rows = [(0, 1, "k", "Drama"), (2, 21, "k", "Action"), (1, 11, "k", "News"), (0, 2, "m", "Music")]
    looked_up = spark.createDataFrame(rows, "batch long, pos long, keyword string, category string")
    assert bag(C.merge_answers(looked_up)) == [("k", "Action", 1), ("m", "Music", 2)]


def test_each_keyword_gets_one_category(spark):
    words = [f"w{i}" for i in range(37)] + ["w3", "w36"]

    def classifier(keywords):
        return json.dumps({k: "Drama" for k in keywords if k != "w5"})

    found = dict(bag(C.classify(positioned(spark, words), classifier), "keyword", "category"))
    assert set(found) == set(words) and len(found) == 37
    assert found["w5"] == "Other" and found["w6"] == "Drama"


def test_missing_answers(spark):
    answered = C.with_parsed_answers(
        spark.createDataFrame([(0, '{"a": "News"}'), (1, "nothing")], "batch long, reply string")
    )
    keywords = positioned(spark, ["a", "b", "b", "c"])
    assert bag(C.not_answered(keywords, answered)) == [("b",), ("c",)]


@pytest.mark.parametrize(
    "keyword,category",
    [
        ("VTV3", "TV Channel"), ("my channel", "TV Channel"), ("htv7 show", "TV Channel"),
        ("running", "Reality Show"), ("Master Key", "Reality Show"),
        ("love story", "Romance"), ("glove", None), ("harry POTTER", "Drama"),
        ("gun", "Action"), ("begun", None), ("olive", None), ("live", "News"),
        ("breaking bad", "News"), ("xem phim", None), ("wará", None),
    ],
)
def test_default_rules(spark, keyword, category):
    df = spark.createDataFrame([(keyword,)], "keyword string")
    assert df.select(category_by_rules(F.col("keyword"))).first()[0] == category


def test_rules_then_names_then_default(spark):
    keywords = positioned(spark, ["NARUTO", "ARGEN", "love", "clip", "S.W.A.T."])
    table = spark.createDataFrame([(k.upper(), c) for k, c in KNOWN_KEYWORDS.items()], CLASSIFIED)
    for known in (KNOWN_KEYWORDS, table):
        found = C.classify_by_rules(keywords, known=known)
        assert found.columns == ["keyword", "pos", "category"]
        assert bag(found, "keyword", "category") == [
            ("ARGEN", "Sports"), ("NARUTO", "Animation"), ("S.W.A.T.", "Action"),
            ("clip", "Other"), ("love", "Romance"),
        ]
    bare = C.classify_by_rules(keywords)
    assert bag(bare, "keyword", "category")[1] == ("NARUTO", "Other")
    assert set(KNOWN_KEYWORDS.values()) <= set(CATEGORIES)


def test_distribution(spark):
    rows = [("a", "Drama"), ("b", "Drama"), ("c", "News"), ("d", "Other"), ("e", None)]
    df = spark.createDataFrame(rows, CLASSIFIED)
    spread = bag(C.category_distribution(df))
    assert spread == [("Drama", 2, 50.0), ("News", 1, 25.0), ("Other", 1, 25.0)]
    assert C.category_distribution(df).columns == ["category", "count", "pct"]
    assert sum(r[2] for r in spread) == pytest.approx(100)
