import base64
import datetime
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.sources.delimited import load_lines, read_delimited_files
from millrace.sources.grammar import RecordGrammar, is_bigint, is_date, is_decimal

COLUMNS = [("a", "text", True), ("b", "bigint", False), ("c", "date", False)]


def brute_cells(line, sep, quote):
    """Character by character; None if quoting is broken."""
    cells, i = [], 0
    while True:
        cell = ""
        if line.startswith(quote, i):
            i += 1
            while True:
                if i >= len(line):
                    return None
                if line[i] == quote:
                    if line.startswith(quote, i + 1):
                        cell, i = cell + quote, i + 2
                        continue
                    i += 1
                    break
                cell, i = cell + line[i], i + 1
            if i < len(line) and not line.startswith(sep, i):
                return None
        else:
            while i < len(line) and not line.startswith(sep, i):
                cell, i = cell + line[i], i + 1
        cells.append(cell)
        if i >= len(line):
            return cells
        i += len(sep)


def brute_valid(line):
    line = line[:-1] if line.endswith("\r") else line
    if not line.strip():
        return False
    cells = brute_cells(line, "||", '"')
    if cells is None or len(cells) != 3 or not cells[0].strip(" "):
        return False
    b, c = cells[1].strip(" "), cells[2].strip(" ")
    if b:
        try:
            ok = b.isascii() and b.strip() == b and "_" not in b and -(2**63) <= int(b) < 2**63
        except ValueError:
            ok = False
        if not ok:
            return False
    if c:
        try:
            if len(c) != 10 or datetime.date.fromisoformat(c).isoformat() != c:
                return False
        except ValueError:
            return False
    return True


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["||", '"', "a", " ", "\n", "7", "-1", "2020-02-29", "2021-02-29", "\r", "|", "x y"]), max_size=12))
def test_lines_agree_with_brute_force(parts):
    line = "".join(parts)
    assert (RecordGrammar("||", '"', COLUMNS).line(line).error is None) == brute_valid(line)


def test_types():
    assert is_bigint("+9223372036854775807") and is_bigint("-9223372036854775808") and is_bigint("0" * 40)
    assert not is_bigint("9223372036854775808") and not is_bigint("-9223372036854775809") and not is_bigint("１２") and not is_bigint("1e3")
    assert is_decimal("-12.30") and is_decimal("7") and not is_decimal("12.") and not is_decimal("1 200.00")
    assert is_date("2020-02-29") and not is_date("2021-02-29") and not is_date("2020-2-9")


def test_file_resumes_at_record_starts():
    grammar = RecordGrammar(",", '"', COLUMNS)
    text = 'x,1,2020-01-01\n"two\nlines",2,\n"broken,3,\ny,4,\nz,5,2020-13-01\nlast,6,'
    records = list(grammar.file(text))
    assert [r.cells for r in records] == [["x", "1", "2020-01-01"], ["two\nlines", "2", ""], None, ["y", "4", ""], None, ["last", "6", ""]]
    assert records[2].error == "quoted cell is not closed" and records[2].at == text.index('"broken')
    assert "cell c" in records[4].error
    assert "\n".join(text[r.start : r.end] for r in records) == text


LAYOUT = "layout_id int, sep string, quotechar string, pos int, column_name string, col_type string, required boolean"
LINES = "line_id bigint, layout_id int, row bigint, line string, name string"


def test_load_lines(spark):
    layouts = spark.createDataFrame([(1, ";", "'", 1, "name", "text", True), (1, ";", "'", 2, "n", "bigint", None), (2, ",", "'", 1, "n", "decimal", False)], LAYOUT)
    lines = spark.createDataFrame([(1, 1, 1, "ann; 5 \r", "x"), (2, 1, 2, None, "x"), (3, 1, 3, "bob;1.5", "x"), (4, 9, 4, "a;1", "x"), (5, None, 5, "a;1", None), (6, 2, 6, " 1.50 ", "x"), (1, 1, 1, "ann; 5 \r", "x")], LINES)
    out = {(r.line_id, i): r for i, r in enumerate(load_lines(lines, layouts).orderBy("line_id").collect())}
    first, second, last = out[(1, 0)], out[(1, 1)], out[(6, 6)]
    assert first == second and first.name == "ann" and first.n == " 5 " and first.in_name == "x" and first._load_error is None
    errors = {k[0]: r._load_error for k, r in out.items() if r._load_error}
    assert errors == {2: "Zero length line", 3: "cell n is not a bigint", 4: "unknown layout", 5: "unknown layout"}
    assert base64.b64decode(out[(3, 3)]._line_b64encoded) == b"bob;1.5" and out[(3, 3)].row == 3 and out[(3, 3)].name is None
    assert last.n == " 1.50 "
    assert load_lines(lines.limit(0), layouts).count() == 0
    assert {r._load_error for r in load_lines(lines.filter("line is not null"), layouts.limit(0)).collect()} == {"unknown layout"}


def test_long_line(spark):
    layouts = spark.createDataFrame([(1, ",", '"', 1, "a", "text", True)], LAYOUT)
    lines = spark.createDataFrame([(1, 1, 1, "x" * 3_000_000, None)], LINES)
    assert len(load_lines(lines, layouts).first().a) == 3_000_000


def test_read_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,1,\n"b,2,\nc,3,\n')
    out = read_delimited_files(spark, str(tmp_path), RecordGrammar(",", '"', COLUMNS)).orderBy("row").collect()
    assert [(r.row, r.cells and r.cells["a"], r._load_error) for r in out] == [(1, "a", None), (2, None, "quoted cell is not closed"), (3, "c", None)]


def test_long_quoted_cells():
    grammar = RecordGrammar(",", '"', [("a", "bigint", True), ("b", "string", False)])
    cell = 'x""y' * 400_000
    text = f'1,"{cell}"'
    assert grammar.line(text).cells == ["1", cell.replace('""', '"')]
    assert [r.error for r in grammar.file(f"{text}\n2,b")] == [None, None]


def test_closing_quote_against_pattern():
    r = random.Random(3)
    grammar = RecordGrammar(",", '"', [("a", "string", False)])
    pattern = re.compile(r'(?s)(?:[^"]|"")*')
    for _ in range(300):
        text = "".join(r.choice('"",\na') for _ in range(r.randint(0, 30)))
        for end in (len(text), len(text) // 2):
            for pos in r.sample(range(end + 1), end + 1):
                assert grammar._close(text, pos, end) == pattern.match(text, pos, end).end(), (text, pos, end)


def test_files_read_whole_fail_where_their_lines_do(spark):
    from millrace.sources.delimited import failed_in_files, failed_lines

    layouts = spark.createDataFrame([(1, ",", '"', 1, "a", "text", True), (1, ",", '"', 2, "n", "bigint", False)], "layout_id int, sep string, quotechar string, pos int, column_name string, col_type string, required boolean")
    texts = ["x,1", '"open,2', "", "y,3", '"q,""r""",4', '"two\nlines",5', "z,bad", "", None, 'w"x,6', '"closed"late,7', "v,8", ",9"]
    rows = [(i, 7, 1, i + 1, t) for i, t in enumerate(texts)] + [(100, 8, 9, 1, "x,1"), (101, 9, 1, 1, '"never closed')]
    lines = spark.createDataFrame(rows, "line_id bigint, file_id bigint, layout_id int, row bigint, line string")
    expected = {r.line_id for r in failed_lines(lines, layouts).collect()}
    assert expected == {1, 2, 6, 7, 8, 10, 12, 100, 101}
    for at_once in (20_000, 4, 1):
        assert {r.line_id for r in failed_in_files(lines, layouts, at_once).collect()} == expected, at_once
    assert failed_in_files(lines.limit(0), layouts).count() == 0
