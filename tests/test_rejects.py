import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spotweave.operators import rejects


def by_hand(s):
    """The fields of a line and the first reason against it, one character after another."""
    if s is None:
        return None, "columns"
    fields, i = [], 0
    while True:
        if s[i : i + 1] == '"':
            j, got = i + 1, ""
            while True:
                if j >= len(s):
                    return None, "quoting"
                if s[j] == '"':
                    if s[j + 1 : j + 2] == '"':
                        got, j = got + '"', j + 2
                        continue
                    break
                got, j = got + s[j], j + 1
            i = j + 1
            if i < len(s) and s[i] != ",":
                return None, "quoting"
        else:
            j = s.find(",", i)
            j = len(s) if j < 0 else j
            got, i = s[i:j], j
            if '"' in got:
                return None, "quoting"
        fields.append(got)
        if i >= len(s):
            break
        i += 1
    if len(fields) != 4:
        return None, "columns"
    name, seq, plus, qual = fields
    checks = [
        ("name", name.startswith("@") and len(name) > 1),
        ("seq", seq != "" and set(seq) <= set("ACGTNacgtn")),
        ("plus", plus.startswith("+")),
        ("qual", qual != "" and all("!" <= c <= "~" for c in qual)),
        ("length", len(seq) == len(qual)),
    ]
    return fields, next((k for k, ok in checks if not ok), None)


def check(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "row_id bigint, raw_line string").repartition(2)
    got = {r.row_id: r for r in rejects.parse_rows(df).collect()}
    assert len(got) == len(lines)
    for i, line in enumerate(lines):
        fields, reason = by_hand(line)
        r = got[i]
        assert r.reason == reason, (line, r, reason)
        assert [r.name, r.seq, r.plus, r.qual] == (fields or [None] * 4), line


def test_cases(spark):
    check(
        spark,
        [
            "@a,AC,+,II", '"@a, b","AC","+","I,"', '"@a",AC,+,""""";"', "@a,AC,+,I", "@a,AC,+,I I", "@,AC,+,II", "a,AC,+,II", "@a,,+,II", "@a,AX,+,II", "@a,AC,,II", "@a,AC,-,II",
            "@a,AC,+,", "@a,AC,+", "@a,AC,+,II,", "", "   ", None, '"@a,AC,+,II', '@a,A"C,+,II', '@a,AC,+,"II"x', '@a,AC,+, "II"', "@a,AC,+,II\r", "@a\nb,AC,+,II", '"@a\n\r",AC,+,II', "@a,AC\n,+,II",
            '@a,AC,+,I\\"', "@é,AC,+,II", "@a,AC,+,é!", "@a,AC,+,\x7f!", "@a,AC,+,II", "@a,nN,+x,!~", ",,,", '"","","",""', "@" + "x" * 3_000_000 + ",AC,+,II", "@a,AC,+,II", "@a,AC,+,II",
        ],
    )


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='@,+"ACI \n\rn\\', max_size=14), min_size=1, max_size=120))
def test_any_text(spark, lines):
    check(spark, lines)


def test_random_fields(spark):
    r = random.Random(1)
    cells = ["@n", "AC", "+", "II", '"II"', '"I,"', '"', "", '"a""b"']
    check(spark, [",".join(r.choice(cells) for _ in range(r.randint(1, 5))) for _ in range(3000)])


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], "row_id bigint, raw_line string, name string, reason int")
    assert rejects.parse_rows(df).count() == 0
    df = spark.createDataFrame([(1, "@a,AC,+,II", "x", 3)], "row_id bigint, raw_line string, name string, reason int")
    assert rejects.loaded(rejects.parse_rows(df)).collect()[0].name == "@a"


@pytest.mark.parametrize("twice", [2, 5])
def test_rows_sent_twice(spark, twice):
    df = spark.createDataFrame([(1, "@a,AC,+,II")] * twice + [(2, "x")] * twice, "row_id bigint, raw_line string")
    parsed = rejects.parse_rows(df)
    assert rejects.loaded(parsed).count() == twice == rejects.rejected(parsed).count()
