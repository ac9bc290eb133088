import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.functions import text as tx

# Some blocks of each language's script, written apart from the rules: (first, last) code points that a transcript may hold,
# and a point just outside them that it may not.
SCRIPTS = {
    "assamese": ([(0x985, 0x98B), (0x9BE, 0x9C3), (0x9F0, 0x9F1)], 0x98C),
    "bengali": ([(0x993, 0x9A8), (0x9AA, 0x9B0), (0x9B2, 0x9B2)], 0x9B1),
    "gujarati": ([(0xA8F, 0xA91), (0xAC7, 0xAC9)], 0xAC6),
    "hindi": ([(0x905, 0x90B), (0x958, 0x95F), (0x30, 0x39)], 0x90C),
    "kannada": ([(0xC92, 0xCA8), (0xCB2, 0xCB3)], 0xCA9),
    "malayalam": ([(0xD12, 0xD28), (0xD7A, 0xD7E)], 0xD29),
    "marathi": ([(0x92A, 0x933), (0x945, 0x945)], 0x934),
    "nepali": ([(0x90F, 0x910), (0x960, 0x960)], 0x911),
    "punjabi": ([(0xA13, 0xA28), (0xA59, 0xA5C)], 0xA29),
    "tamil": ([(0xB8E, 0xB90), (0xBAE, 0xBB9)], 0xB91),
    "telugu": ([(0xC2A, 0xC33), (0xC60, 0xC60)], 0xC34),
    "urdu": ([(0x62A, 0x63A), (0x6D2, 0x6D3)], 0x63B),
    "indian_english": ([(0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39), (0x27, 0x27)], 0x3C6),
}
DELETED = "!#%,.;?[]{}|~\u0964"


def spelt(ranges):
    return " ".join(chr(a) + chr((a + b) // 2) + chr(b) for a, b in ranges)


CASES = []
for lang_, (ranges_, outside_) in SCRIPTS.items():
    plain_ = spelt(ranges_)
    CASES += [
        (lang_, plain_, plain_),
        (lang_, "\t " + plain_ + " \n", plain_),
        (lang_, plain_.replace(" ", "-"), plain_),
        (lang_, DELETED + plain_ + DELETED, plain_),
        (lang_, plain_ + "\n" + plain_, plain_ + "\n" + plain_),
        (lang_, plain_ + chr(outside_), None),
        (lang_, chr(0x3B2) + plain_, None),
        (lang_, plain_ + "$", None),
        (lang_, " ", None),
        (lang_, DELETED, None),
    ]
CASES += [(lang_, spelt(SCRIPTS[lang_][0]) + "z9", None) for lang_ in SCRIPTS if lang_ != "indian_english"]
CASES += [
    ("hindi", "7:45", None),
    ("indian_english", "7:45", None),
    ("indian_english", "don't", "don't"),
    ("no such language", spelt(SCRIPTS["hindi"][0]), spelt(SCRIPTS["hindi"][0])),
    ("no such language", "plain", None),
]


def test_sanitise_cases(spark):
    data = spark.createDataFrame([(i, lang, text) for i, (lang, text, _) in enumerate(CASES)], "i int, lang string, text string")
    checked = data.withColumn("s", tx.sanitise_by(F.col("text"), F.col("lang")))
    got = {r.i: r for r in checked.select("i", "s.clean", "s.reason").collect()}
    for i, (lang, text, want) in enumerate(CASES):
        assert got[i].clean == want, (lang, text, got[i])
        assert (got[i].reason is None) == (want is not None)


def test_reject_reasons(spark):
    data = spark.createDataFrame([("6:10",), (" -?",), ("q",), (None,)], "t string")
    reasons = [r[0] for r in data.select(tx.sanitise(F.col("t"), "hindi")["reason"]).collect()]
    assert reasons[:2] == ["transcription has :", "transcription is empty"]
    assert reasons[2].startswith("transcription has a character") and reasons[3] is None


def test_registered_rule(spark):
    tx.register_rule("digits", tx.LanguageRule("0030-0039"))
    try:
        data = spark.createDataFrame([("1-2",), ("12a",)], "t string")
        assert [r[0] for r in data.select(tx.sanitise(F.col("t"), "digits")["clean"]).collect()] == ["1 2", None]
    finally:
        del tx.RULES["digits"]


@pytest.mark.parametrize(
    "build,value,want",
    [
        (tx.condition_file_name, "a(1)&'b.c.mp4", "a1b_c.mp4"),
        (tx.condition_file_name, "plain", ".plain"),
        (tx.base_name, "a/b/c.wav", "c.wav"),
        (tx.extension, "a.b.wav", "wav"),
        (tx.first_stem, "a.b.wav", "a"),
        (tx.last_stem, "a.b.wav", "a.b"),
        (lambda c: tx.companion_name(c, ".csv"), "a.b.mp4", "a.b.csv"),
        (tx.bucket_of, "//bucket//x/y", "bucket"),
        (tx.path_in_bucket, "//bucket//x/y/", "x/y"),
        (tx.path_in_bucket, "bucket", ""),
        (lambda c: tx.fill_language(c, "hindi"), "a/{language}/b", "a/hindi/b"),
        (tx.gender_name, "m", "male"),
        (tx.gender_name, "f", "female"),
        (tx.gender_name, "x", "non-specified"),
        (tx.gender_name, None, "non-specified"),
        (tx.is_true, "TRUE", True),
        (tx.is_true, None, False),
        (tx.is_csv_path, "a/b.csv", True),
        (lambda c: tx.extension_matches(c, "mp4"), "MP4", True),
        (lambda c: tx.extension_matches(c, "mp4"), "Mp4", False),
        (tx.parse_tool_output, "17.25 of speech", 17.25),
        (tx.parse_tool_output, "nan of speech", 0.0),
        (tx.parse_tool_output, "failed", -1.0),
    ],
)
def test_names_and_values(spark, build, value, want):
    data = spark.createDataFrame([(value,)], "v string")
    assert data.select(build(F.col("v")).alias("r")).first()[0] == want


def test_dates(spark):
    data = spark.sql("select timestamp '2021-03-04 05:06:07.123456' as t")
    row = data.select(
        tx.export_stamp(F.col("t")),
        tx.report_stamp(F.col("t")),
        tx.id_from_time(F.col("t")),
        tx.artifact_name(F.lit("hindi"), F.lit("src"), tx.export_stamp(F.col("t"))),
    ).first()
    assert list(row) == ["04-03-2021_05-06", "03_04_2021_05_06_07", "202103040506071234", "hindi_src_04-03-2021_05-06.zip"]


def test_alternatives_are_joined(spark):
    data = spark.sql(
        "select array(named_struct('alternatives', array(named_struct('transcript', 'a b'), named_struct('transcript', 'x'))),"
        " named_struct('alternatives', array(named_struct('transcript', 'c')))) as r"
    )
    assert rows_of(data.select(tx.join_alternatives(F.col("r")))) == [("a b c",)]
