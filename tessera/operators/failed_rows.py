"""Rows that fail to parse: minimum-cost error parse of delimited lines.

A line is read by dynamic programming over its quotes, delimiters and text runs. Insertions and deletions of
quotes cost most, insertions and deletions of delimiters less, a cell whose value its column refuses least; the
costs are so far apart that the cheapest repair names the first layout rule a line breaks. A line whose cheapest
parse costs nothing is valid and loads typed; for every other line the edit operations state the reason:

* any quote edit                 -> ``broken_quoting``
* otherwise any delimiter edit   -> ``wrong_column_count``
* otherwise any refused value    -> ``invalid_value``

Edits of delimiters are never allowed next to a quote, so they cannot hide broken quoting. Null and blank lines are
lines of one empty cell (``wrong_column_count``). A null delimiter means a comma. Very long lines are read whole.
Most lines need no repair: they are read by one regular expression that is the zero-cost path of the parse, and the
tables of the dynamic program are only filled for lines it can't take. Its time is linear in the length of the line.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So far apart that no number of lesser edits of a line of 100 million cells outweighs a greater one.
QUOTE_EDIT, DELIMITER_EDIT, REFUSED = 10**12, 10**4, 1
CODES = ("broken_quoting", "wrong_column_count", "invalid_value")


@dataclass(frozen=True)
class Field:
    """A column of a layout: a pattern (no anchors or lookarounds) the whole cell must match, an optional further test, the Spark type to load."""

    name: str
    pattern: str = r"(?s).*"
    spark_type: str = "string"
    test: Callable[[str], bool] | None = None
    strip: str = ""

    def accepts_at(self, text: str, start: int, end: int) -> bool:
        """As accepts for text[start:end], which is only cut out if there is a further test."""
        return _compiled(self.pattern).fullmatch(text, start, end) is not None and (self.test is None or self.test(text[start:end]))

    def accepts(self, cell: str) -> bool:
        return _compiled(self.pattern).fullmatch(cell) is not None and (self.test is None or self.test(cell))


@lru_cache(maxsize=256)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def is_date(cell: str) -> bool:
    """Whether cell is a day of the calendar written yyyy-mm-dd."""
    try:
        date(int(cell[:4]), int(cell[5:7]), int(cell[8:10]))
    except ValueError:
        return False
    return True


def one_of(*words: str) -> str:
    return "|".join(map(re.escape, words))


# ---- the zero-cost path ------------------------------------------------------------------------------------------


@lru_cache(maxsize=64)
def _cell_pattern(delimiter: str) -> re.Pattern:
    d = re.escape(delimiter)
    return re.compile(rf'(?:"((?:[^"]|"")*)"|([^"{d}]*))(?:{d}|\Z)', re.S)


def strict_cells(line: str, delimiter: str) -> list[str] | None:
    """Cells of a line that needs no quote edit, else None."""
    cells, at, end = [], 0, len(line)
    match = _cell_pattern(delimiter).match
    while True:
        m = match(line, at)
        if m is None:
            return None
        quoted = m.group(1)
        cells.append(m.group(2).strip(" ") if quoted is None else quoted.replace('""', '"') if '""' in quoted else quoted)
        at = m.end()
        if at == end and (m.end(1 if quoted is not None else 2) + (quoted is not None)) == end:
            return cells


# ---- the repair of quotes ------------------------------------------------------------------------------------------

START, BARE, QUOTED, CLOSED, LITERAL, CLOSED_LITERAL = range(6)  # the literal modes hold a quote written twice
_ENDS = (START, BARE, CLOSED, CLOSED_LITERAL)
_FAR = 1 << 60
#: mode -> mode at no cost but an inserted quote, in the order in which they can follow each other.
_INSERTED = ((START, QUOTED), (QUOTED, CLOSED), (LITERAL, CLOSED_LITERAL))
#: (mode, mode after, quote edits) of a quote, a delimiter and a run of text.
_AT_QUOTE = ((START, QUOTED, 0), (START, BARE, 1), (BARE, BARE, 1), (QUOTED, CLOSED, 0), (QUOTED, QUOTED, 1), (LITERAL, CLOSED_LITERAL, 0), (LITERAL, LITERAL, 1))
_AT_DELIMITER = ((QUOTED, QUOTED, 0), (LITERAL, LITERAL, 0), *((m, START, 0) for m in _ENDS))
_AT_TEXT = ((START, BARE, 0), (BARE, BARE, 0), (QUOTED, QUOTED, 0), (LITERAL, LITERAL, 0))
_DOUBLED = ((QUOTED, LITERAL), (LITERAL, LITERAL))


def _quote_costs(tokens: list[str], delimiter: str) -> tuple[list[list[int]], list[list[int]], list[tuple], list[bool]]:
    """Least quote edits up to and from each (token, mode), the moves at each token, and where a quote is doubled."""
    n = len(tokens)
    moves = [_AT_QUOTE if t == '"' else _AT_DELIMITER if t == delimiter else _AT_TEXT for t in tokens]
    doubled = [t == '"' and i + 1 < n and tokens[i + 1] == '"' for i, t in enumerate(tokens)]
    ahead = [[_FAR] * 6 for _ in range(n + 1)]
    ahead[0][START] = 0
    for i in range(n + 1):
        at = ahead[i]
        for m, to in _INSERTED:
            if (m != START or i < n) and at[m] + 1 < at[to]:
                at[to] = at[m] + 1
        if i == n:
            break
        after = ahead[i + 1]
        for m, to, cost in moves[i]:
            if at[m] + cost < after[to]:
                after[to] = at[m] + cost
        if doubled[i]:
            beyond = ahead[i + 2]
            for m, to in _DOUBLED:
                if at[m] < beyond[to]:
                    beyond[to] = at[m]
    back = [[_FAR] * 6 for _ in range(n + 1)]
    for m in _ENDS:
        back[n][m] = 0
    for i in range(n, -1, -1):
        at = back[i]
        if i < n:
            after = back[i + 1]
            for m, to, cost in moves[i]:
                if after[to] + cost < at[m]:
                    at[m] = after[to] + cost
            if doubled[i]:
                for m, to in _DOUBLED:
                    if back[i + 2][to] < at[m]:
                        at[m] = back[i + 2][to]
        for m, to in reversed(_INSERTED):
            if (m != START or i < n) and at[to] + 1 < at[m]:
                at[m] = at[to] + 1
    return ahead, back, moves, doubled


_TAKE, _DROP, _MISS = "take", "drop", "miss"


def repair(line: str, delimiter: str, layout: Sequence[Field]) -> tuple[list[str | None], list[str], list[str], list[str]]:
    """(value of each column, quote edits, delimiter edits, refused columns) of the cheapest parse of a line, in linear time.

    First the least number of quote edits on each side of every (token, mode) is found. Moves on no parse of least quote
    edits are left out; over the others runs the program of cells and columns: state (token, mode, columns filled), moves
    take a cell, drop it (a delimiter too many), miss a column (one too few). It is exact for layouts whose columns
    either take quotes in a value whatever stands around them or refuse every value with a quote. States per token are
    at most six times the columns.
    """
    tokens = re.findall(rf'"|{re.escape(delimiter)}|[^"{re.escape(delimiter)}]+', line)
    ahead, back, moves, doubled = _quote_costs(tokens, delimiter)
    n, columns = len(tokens), len(layout)
    least = min(ahead[n][m] for m in _ENDS)
    places = [0]
    for t in tokens:
        places.append(places[-1] + len(t))

    plain, offsets = line.replace('"', ""), [0]
    for t in tokens:
        offsets.append(offsets[-1] + (len(t) if t != '"' else 0))
    with_quotes = [f.accepts('"') for f in layout]

    def text_of(entry: tuple, mode: int) -> str:
        parts = []
        while entry[3] is None and entry[1] is not None:
            parts.append(entry[2])
            entry = entry[1]
        text = "".join(reversed(parts))
        return text if mode in (CLOSED, CLOSED_LITERAL) else text.strip(" ")

    def fits(k: int, mode: int, start: int, end: int) -> bool:
        if mode == CLOSED_LITERAL:
            return with_quotes[k]
        if mode != CLOSED:
            while start < end and plain[start] == " ":
                start += 1
            while start < end and plain[end - 1] == " ":
                end -= 1
        return layout[k].accepts_at(plain, start, end)

    # an entry: (cost, entry before, text added, (action, column, mode) at the end of a cell, quote edit, where its cell starts in plain)
    layers: list[dict] = [{} for _ in range(n + 2)]
    layers[0][START, 0] = (0, None, "", None, None, 0)

    def relax(layer: dict, key: tuple[int, int], entry: tuple) -> None:
        held = layer.get(key)
        if held is None or entry[0] < held[0]:
            layer[key] = entry

    def finish(layer: dict, mode: int, k: int, entry: tuple, end: int, after: int) -> None:
        if k < columns:
            relax(layer, (START, k + 1), (entry[0] + (0 if fits(k, mode, entry[5], end) else REFUSED), entry, "", (_TAKE, k, mode), None, after))
        relax(layer, (START, k), (entry[0] + DELIMITER_EDIT, entry, "", (_DROP, k, mode), None, after))

    def miss(layer: dict) -> None:
        for k in range(columns):
            if (held := layer.get((START, k))) is not None and (held[3] is not None or held[1] is None):
                relax(layer, (START, k + 1), (held[0] + DELIMITER_EDIT, held, "", (_MISS, k, START), None, held[5]))

    for i in range(n):
        layer, at = layers[i], ahead[i]
        miss(layer)
        for m, to in _INSERTED:
            if at[m] + 1 + back[i][to] == least:
                for k in range(columns + 1):
                    if (held := layer.get((m, k))) is not None:
                        relax(layer, (to, k), (held[0], held, "", None, f"insert quote at {places[i]}", held[5]))
        token = tokens[i]
        piece = "" if token == '"' else token
        for m, to, cost in moves[i]:
            if at[m] + cost + back[i + 1][to] != least:
                continue
            edit = f"delete quote at {places[i]}" if cost else None
            for k in range(columns + 1):
                if (held := layer.get((m, k))) is None:
                    continue
                if to == START:
                    finish(layers[i + 1], m, k, held, offsets[i], offsets[i + 1])
                else:
                    relax(layers[i + 1], (to, k), (held[0], held, piece, None, edit, held[5]))
        if doubled[i]:
            for m, to in _DOUBLED:
                if at[m] + back[i + 2][to] == least:
                    for k in range(columns + 1):
                        if (held := layer.get((m, k))) is not None:
                            relax(layers[i + 2], (to, k), (held[0], held, '"', None, None, held[5]))
        layers[i] = {}
    for m, to in _INSERTED[1:]:
        if ahead[n][m] + 1 + back[n][to] == least:
            for k in range(columns + 1):
                if (held := layers[n].get((m, k))) is not None:
                    relax(layers[n], (to, k), (held[0], held, "", None, f"insert quote at {places[n]}", held[5]))
    done: dict = {}
    miss(layers[n])
    for (m, k), held in list(layers[n].items()):
        if m in _ENDS and ahead[n][m] == least:
            finish(done, m, k, held, offsets[n], offsets[n])
    miss(done)
    values: list[str | None] = [None] * columns
    quotes, moved, refused, cell = [], [], [], 0
    chain, entry = [], done[START, columns]
    while entry is not None:
        chain.append(entry)
        entry = entry[1]
    for _, entry, _, action, edit, _ in reversed(chain):
        if edit:
            quotes.append(edit)
        if action is None:
            continue
        what, k, mode = action
        cell += what != _MISS
        if what == _TAKE:
            values[k] = text_of(entry, mode)
            if not layout[k].accepts(values[k]):
                refused.append(layout[k].name)
        else:
            moved.append(f"delete delimiter at cell {cell}" if what == _DROP else f"insert delimiter for {layout[k].name}")
    return values, quotes, moved, refused


# ---- the alignment of cells with columns ---------------------------------------------------------------------------


def align(cells: Sequence[str], layout: Sequence[Field]) -> tuple[list[str | None], list[str], list[str]]:
    """Cells set against the columns at the least cost: (value of each column, delimiter edits, refused columns).

    The same program as in `repair` for lines whose quotes, and so whose cells, are in order.
    """
    n, m = len(cells), len(layout)
    if n == m:
        return list(cells), [], [f.name for f, c in zip(layout, cells) if not f.accepts(c)]
    before = [j * DELIMITER_EDIT for j in range(m + 1)]
    steps = [bytes(m + 1)]  # 0 insert, 1 delete, 2 take
    for i, cell in enumerate(cells, 1):
        row, step = [i * DELIMITER_EDIT], bytearray(m + 1)
        step[0] = 1
        for j in range(1, m + 1):
            best, how = row[j - 1] + DELIMITER_EDIT, 0
            if (cost := before[j] + DELIMITER_EDIT) <= best:
                best, how = cost, 1
            if before[j - 1] <= best and (cost := before[j - 1] + (0 if layout[j - 1].accepts(cell) else REFUSED)) <= best:
                best, how = cost, 2
            row.append(best)
            step[j] = how
        before = row
        steps.append(bytes(step))
    i, j, values, edits, refused = n, m, [None] * m, [], []
    while i or j:
        how = steps[i][j] if i else 0
        if how == 2:
            i, j = i - 1, j - 1
            values[j] = cells[i]
            if not layout[j].accepts(cells[i]):
                refused.append(layout[j].name)
        elif how == 1:
            i -= 1
            edits.append(f"delete delimiter at cell {i + 1}")
        else:
            j -= 1
            edits.append(f"insert delimiter for {layout[j].name}")
    return values, edits[::-1], refused[::-1]


def parse_line(line: str | None, delimiter: str | None, layout: Sequence[Field]) -> tuple[list[str | None], str | None, list[str], int]:
    """(cells, failure code or None, edits, cost) of one line."""
    line, delimiter = line or "", delimiter or ","
    cells = strict_cells(line, delimiter)
    if cells is not None and len(cells) == len(layout) and all(f.accepts(c) for f, c in zip(layout, cells)):
        return cells, None, [], 0
    quotes: list[str] = []
    if cells is None:
        values, quotes, moved, refused = repair(line, delimiter, layout)
    else:
        values, moved, refused = align(cells, layout)
    cost = len(quotes) * QUOTE_EDIT + len(moved) * DELIMITER_EDIT + len(refused) * REFUSED
    code = CODES[0] if quotes else CODES[1] if moved else CODES[2]
    return values, code, [*quotes, *moved, *(f"refused {x}" for x in refused)], cost


OUTCOME = T.StructType([
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("failure_code", T.StringType()),
    T.StructField("edits", T.ArrayType(T.StringType())),
    T.StructField("cost", T.LongType()),
])


def parse_outcome(line: Column, delimiter: Column, layout: Sequence[Field]) -> Column:
    """The parse of a line as a struct: cells, failure_code (null: valid), edits, cost."""

    @F.pandas_udf(OUTCOME)
    def outcome(lines: pd.Series, delimiters: pd.Series) -> pd.DataFrame:
        out = [parse_line(a if isinstance(a, str) else None, d if isinstance(d, str) else None, layout) for a, d in zip(lines, delimiters)]
        return pd.DataFrame(out, columns=["cells", "failure_code", "edits", "cost"], dtype=object)

    # a filter on the outcome must not run the parse again below the projection
    return outcome.asNondeterministic()(line, delimiter)


def split_failures(lines: DataFrame, layout: Sequence[Field], text: str, delimiter: Column, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, failed rows) of a table of lines.

    Valid rows hold the `keep` columns and every field of the layout with its type; failed rows the `keep` columns,
    failure_code, reason (the edits joined), n_edits and the raw line. Columns of the layout that clash with a kept
    name win over it nowhere: they come out as ``value_<name>``. Empty input gives empty, typed results.
    """
    parsed = lines.select(*keep, F.col(text).alias("_raw"), parse_outcome(F.col(text), delimiter, layout).alias("_o"))
    valid = parsed.where("_o.failure_code is null")
    typed = []
    for k, f in enumerate(layout):
        cell = F.nullif(F.col("_o.cells")[k], F.lit(""))
        if f.strip:
            cell = F.regexp_replace(cell, f.strip, "")
        typed.append(cell.try_cast(f.spark_type).alias(f"value_{f.name}" if f.name in keep else f.name))
    failed = parsed.where("_o.failure_code is not null").select(
        *keep, F.col("_o.failure_code").alias("failure_code"), F.array_join("_o.edits", "; ").alias("reason"),
        F.size("_o.edits").alias("n_edits"), F.col("_raw").alias("raw_input"),
    )
    return valid.select(*keep, *typed), failed


#: The layout of the exports of this project (fixed values).
EXPORT_LAYOUT = (
    Field("source_key", r"[a-z]{2}"),
    Field("edition_year", r"[0-9]{4}", "int", lambda c: 1980 <= int(c) <= 2030),
    Field("field_name"),
    Field("ordinal", r"[0-9]+", "bigint"),
    Field("raw"),
    Field("amount", r"|-?(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)(?:\.[0-9]+)?", "decimal(38,10)", strip=","),
    Field("status", one_of("parsed_exact", "parsed_with_qualifier", "parsed_partial", "unparsed")),
    Field("failure_code", one_of("", "empty", "explanatory_note_not_a_value", "no_number_found", "number_unparseable", "out_of_range")),
    Field("published_on", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "date", is_date),
)


def export_lines(raw_line: DataFrame, artifact: DataFrame) -> DataFrame:
    """The record lines of the exports (line_no > 1) with the delimiter of their file; a line without file gets a comma."""
    files = artifact.groupBy("artifact_id").agg(F.max("delimiter").alias("delimiter"))
    lines = raw_line.where("line_no > 1").select("raw_line_id", "artifact_id", "line_no", "line_text")
    return lines.join(files, "artifact_id", "left")


def export_outcome(raw_line: DataFrame, artifact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, failed) records of the exports."""
    return split_failures(export_lines(raw_line, artifact), EXPORT_LAYOUT, "line_text", F.col("delimiter"), ["raw_line_id", "artifact_id", "line_no"])
