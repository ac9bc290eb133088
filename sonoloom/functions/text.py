"""Column expressions for transcripts, names and paths.  No Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonoloom.functions.vectors import let

# Characters valid in a transcript of each language (hexadecimal code points,
# inclusive ranges), the punctuation that is deleted, and the gender names.
VALID_CODE_POINTS = {
    "assamese": "0020 0981-0983 0985-098B 098F-0990 0993-099A 099A-09A8 09AA-09AF 09B2 09B6-09B9 09BE-09C3 "
    "09C7-09C8 09CB-09CE 09D7 09DC-09DD 09DF-09E0 09F0-09F1 09FA",
    "bengali": "0020 0981-0983 0985-098B 098F-0990 0993-09A8 09AA-09B0 09B2 09B6-09B9 09BC 09BE-09CD 09C7-09C8 "
    "09CB-09CE 09DF",
    "gujarati": "0020 0A81-0A83 0A85-0A8B 0A8D 0A8F-0A91 0A93-0AA8 0AAA-0AB0 0AB2-0AB3 0AB5-0AB9 0ABE-0AC5 "
    "0AC7-0AC9 0ACB-0ACD",
    "hindi": "0020 0901-0903 0905-090B 090F-0911 0913-0928 092A-0930 0932 0935-0939 093C 093E-0943 0947-0949 "
    "094B-094D 0030-0039 0958-095F 0945",
    "indian_english": "0020 0061-007A 0041-005A 0030-0039 0027",
    "kannada": "0020 0C82-0C83 0C85-0C8B 0C8E-0C90 0C92-0CA8 0CAA-0CB0 0CB2-0CB3 0CB5-0CB9 0CBE-0CC4 0CC6-0CC8 "
    "0CCA-0CCD 0CF2",
    "malayalam": "0020 0D02-0D03 0D05-0D0B 0D0E-0D10 0D12-0D28 0D2A-0D3A 0D3E-0D43 0D46-0D48 0D4A-0D4D 0D7A-0D7E",
    "marathi": "0020 0901-0903 0905-090B 090F-0911 0913-0928 092A-0933 0935-0939 093E-0943 0945 0947-0949 094B-094D",
    "nepali": "0020 0901-0903 0905-090B 090F-0910 0913-0928 092A-0930 0932 0935-0939 093C 093E-0943 0947-0949 "
    "094B-094D 0960",
    "punjabi": "0020 0A3C 0A02 0A4D 0A51 0A3E 0A3F 0A40 0A41 0A42 0A47 0A48 0A4B 0A70 0A71 0A05-0A0A 0A0F-0A10 "
    "0A13-0A28 0A2A-0A30 0A32 0A33 0A35 0A36 0A38 0A39 0A59-0A5C 0A5E",
    "tamil": "0020 0B83 0B85-0B8A 0B8E-0B90 0B92-0B95 0B99-0B9A 0B9C 0B9E-0B9F 0BA3-0BA4 0BA8-0BAA 0BAE-0BB9 "
    "0BBE-0BC2 0BC6-0BC8 0BCA-0BCD",
    "telugu": "0020 0C02-0C03 0C05-0C0C 0C0E-0C10 0C12-0C28 0C2A-0C33 0C35-0C39 0C3E-0C44 0C46-0C48 0C4A-0C4D 0C60",
    "urdu": "0020 0621-0622 0624 0626-0628 062A-063A 0641-0642 0644-0646 0648 0654 0679 067E 0686 0688 0691 0698 "
    "06A9 06AF 06BA 06BE 06C1 06CC 06D2-06D3",
}
PUNCTUATION = "!\"#%&'()*+,./;<=>?@[\\]^_`{|}~।"
GENDER_NAMES = {"m": "male", "f": "female"}

# Whitespace as Python's str.strip sees it.
_SPACE_POINTS = "0009-000D 001C-0020 0085 00A0 1680 2000-200A 2028 2029 202F 205F 3000"


def _characters(code_points: str) -> str:
    """The characters of ranges such as ``0009-000D 0020``."""
    ends = [part.split("-") for part in code_points.split()]
    return "".join(chr(c) for pair in ends for c in range(int(pair[0], 16), int(pair[-1], 16) + 1))


def _pattern(code_points: str) -> str:
    """The same ranges inside a regular-expression class, always as escapes."""
    return "".join("-".join(rf"\x{{{end}}}" for end in part.split("-")) for part in code_points.split())


@dataclass(frozen=True)
class LanguageRule:
    """What a transcript of one language may hold and what is removed from it first."""

    code_points: str
    punctuation: str = PUNCTUATION
    reject_colon: bool = False

    def outside(self) -> str:
        """Pattern of a character that is neither valid nor whitespace."""
        return f"[^{_pattern(self.code_points)}{_pattern(_SPACE_POINTS)}]"


RULES = {name: LanguageRule(points) for name, points in VALID_CODE_POINTS.items()}
RULES["hindi"] = LanguageRule(VALID_CODE_POINTS["hindi"], reject_colon=True)
RULES["indian_english"] = LanguageRule(VALID_CODE_POINTS["indian_english"], PUNCTUATION.replace("'", ""))
RULES["default"] = RULES["hindi"]


def register_rule(language: str, rule: LanguageRule) -> None:
    RULES[language] = rule


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_characters(_SPACE_POINTS)))


def _checked(text: Column, language: str) -> Column:
    rule = RULES.get(language, RULES["default"])
    first = strip(text)
    kept = strip(F.translate(first, "-" + rule.punctuation, " "))

    def judge(clean: Column) -> Column:
        reason = F.when(F.lit(rule.reject_colon) & first.contains(":"), "transcription has :")
        reason = reason.when(F.length(clean) == 0, "transcription is empty")
        reason = reason.when(clean.rlike(rule.outside()), "transcription has a character outside its language")
        return let(reason, lambda why: F.struct(F.when(why.isNull(), clean).alias("clean"), why.alias("reason")))

    return let(kept, judge)


def sanitise(text: Column, language: str) -> Column:
    """struct(clean, reason): the clean text, or why it is rejected; the other one is NULL."""
    return _checked(text, language)


def sanitise_by(text: Column, language: Column, languages: Sequence[str] = tuple(VALID_CODE_POINTS)) -> Column:
    """As :func:`sanitise`, with the language of each row; an unknown one uses the default."""
    branches = F.when(F.lit(False), _checked(text, "default"))
    for name in languages:
        branches = branches.when(language == name, _checked(text, name))
    return branches.otherwise(_checked(text, "default"))


def condition_file_name(name: Column) -> Column:
    """Delete ``()&'``, turn inner dots into ``_``; a name without a dot gains a leading one."""
    kept = F.regexp_replace(F.translate(name, "()&'", ""), r"\.(?=[^\n]*\.)", "_")
    return F.when(kept.contains("."), kept).otherwise(F.concat(F.lit("."), kept))


def base_name(path: Column, delimiter: str = "/") -> Column:
    return F.substring_index(path, delimiter, -1)


def extension(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def first_stem(name: Column) -> Column:
    """Name up to the first dot."""
    return F.substring_index(name, ".", 1)


def last_stem(name: Column) -> Column:
    """Name up to the last dot; empty when there is none."""
    return F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)


def companion_name(name: Column, meta_extension: str) -> Column:
    return F.concat(last_stem(name), F.lit(meta_extension))


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def path_segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def bucket_of(path: Column) -> Column:
    return F.get(path_segments(path), 0)


def path_in_bucket(path: Column) -> Column:
    segments = path_segments(path)
    return F.array_join(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), "/")


def fill_language(template: Column, language: Column | str) -> Column:
    value = F.lit(language) if isinstance(language, str) else language
    return F.replace(template, F.lit("{language}"), value)


def gender_name(gender: Column) -> Column:
    names = F.when(F.lit(False), F.lit(None).cast("string"))
    for short, long in GENDER_NAMES.items():
        names = names.when(gender == short, long)
    return names.otherwise("non-specified")


def is_true(text: Column) -> Column:
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def is_csv_path(path: Column) -> Column:
    return F.endswith(path, F.lit(".csv"))


def extension_matches(ext: Column, expected: str) -> Column:
    """Equal to the expected extension or to it with the case swapped."""
    return ext.isin(expected, expected.swapcase())


def join_alternatives(results: Column) -> Column:
    """First alternative of each recogniser result, joined with spaces."""
    return F.array_join(F.transform(results, lambda r: r["alternatives"][0]["transcript"]), " ")


def parse_tool_output(output: Column) -> Column:
    """Third-last word of the quality tool's output; NaN becomes 0, unreadable becomes -1."""
    words = F.filter(F.split(output, r"\s+"), lambda w: w != "")
    value = F.try_element_at(words, F.lit(-3)).try_cast("double")
    return F.when(value.isNull(), F.lit(-1.0)).otherwise(F.nanvl(value, F.lit(0.0)))


def report_stamp(ts: Column) -> Column:
    return F.date_format(ts, "MM_dd_yyyy_HH_mm_ss")


def export_stamp(ts: Column) -> Column:
    return F.date_format(ts, "dd-MM-yyyy_HH-mm")


def id_from_time(ts: Column) -> Column:
    """Digits of the time down to 1/10000 s."""
    return F.date_format(ts, "yyyyMMddHHmmssSSSS")


def artifact_name(language: Column, source: Column, stamp: Column) -> Column:
    return F.concat(F.concat_ws("_", language, source, stamp), F.lit(".zip"))
