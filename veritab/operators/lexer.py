"""Reading SQL scripts: statements, their code without texts and comments, and the levels of their brackets.

A script is walked from mark to mark with a state: code, a text, a quoted name, a comment of some depth, or a text
between dollar tags. Only the marks of the state count, so a semicolon in a text ends no statement and a quote in a
comment opens no text. A script longer than CHUNK is cut at line ends. Each chunk says, for every state that it may
be entered in, which state it leaves and how many statements it ends; these steps are chained in order, and then the
chunks are read in parallel, each from the state that it is really entered in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.session import materialise

#: Characters of a script that are read by one task, up to the next line end.
CHUNK = 1 << 18

# States: "" is code, "'" a text, "e" a text with escapes, '"' and "`" names, "-" a comment up to the line end,
# "/3" a comment that three closing marks end, "$tag$" a text between tags.
_OPENING = re.compile(r"""(?<![\w$])[eE]'|['"`;]|--|/\*|(?<![\w$])\$(?:[A-Za-z_]\w*)?\$""")
_ESCAPED = re.compile(r"(?:[^'\\]|\\.|'')*+'", re.S)
_COMMENT = re.compile(r"/\*|\*/")
_TAG = re.compile(r"(?=(\$(?:[A-Za-z_]\w*)?\$))")  # also those that overlap, as in $a$b$
_SIMPLE = {"'": "'", '"': '"', "`": "`", "-": "\n"}


def _close(text: str, at: int, state: str) -> tuple[int, str]:
    """Where the state ends, and the state from there on; the end of the text if it does not end."""
    if state[0] == "/":
        depth = int(state[1:])
        for m in _COMMENT.finditer(text, at):
            depth += 1 if m.group() == "/*" else -1
            if not depth:
                return m.end(), ""
        return len(text), f"/{depth}"
    if state == "e":
        m = _ESCAPED.match(text, at)
        return (m.end(), "") if m else (len(text), state)
    mark = _SIMPLE.get(state, state)
    end = text.find(mark, at)
    return (end + len(mark), "") if end >= 0 else (len(text), state)


def walk(text: str, state: str = "", backslash: bool = False, at: int = 0) -> Iterator[tuple[str, int, int]]:
    """Pieces (state, start, end) of a text; ``;`` is a piece of its own. The last one, of no length, has the state at the end."""
    while at < len(text):
        if state:
            start, own = at, state
            at, state = _close(text, at, state)
            yield own, start, at
            continue
        m = _OPENING.search(text, at)
        if m is None:
            yield "", at, len(text)
            break
        if m.start() > at:
            yield "", at, m.start()
        mark, at = m.group(), m.end()
        if mark == ";":
            yield ";", m.start(), at
            continue
        own = {"--": "-", "/*": "/1"}.get(mark, "e" if mark[-1] == "'" and (backslash or len(mark) > 1) else mark)
        at, state = _close(text, at, own)
        yield own, m.start(), at
    yield state, at, at


def fragments(text: str, state: str = "", position: int = 0, backslash: bool = False) -> Iterator[tuple[int, str, str]]:
    """(position, statement, code): the parts of statements in a text. Comments are blanks; in code texts are ``''``."""
    whole, code = [], []
    for own, start, end in walk(text, state, backslash):
        if start == end:
            continue
        if own == ";":
            yield position, "".join(whole), "".join(code)
            whole, code, position = [], [], position + 1
        elif own and own[0] in "-/":
            whole.append(" "), code.append(" ")
        else:
            piece = text[start:end]
            whole.append(piece)
            # A text that was opened before has left its mark there.
            code.append(piece if own in ("", '"', "`") else "''" if start or not state else "")
    yield position, "".join(whole), "".join(code)


def steps(text: str, backslash: bool = False) -> list[tuple[str, str, int]]:
    """(state on entry, state at the end, statements ended) of a chunk, for all states in which that differs from the default.

    By default a text between tags goes on. A comment that is deeper than all listed ones goes on, and the entry ``/``
    has the change of its depth.
    """

    def run(at: int) -> tuple[str, int]:
        ends, state = 0, ""
        for own, _, _ in walk(text, "", backslash, at):
            ends, state = ends + (own == ";"), own
        return state, ends

    starts = {"": 0}
    for state in ("'", "e", '"', "`"):
        end, after = _close(text, 0, state)
        starts[state] = None if after else end
    for m in _TAG.finditer(text):
        starts.setdefault(m.group(1), m.end(1))
    depth = 0
    for m in _COMMENT.finditer(text):
        depth += 1 if m.group() == "/*" else -1
        if depth < 0:
            starts.setdefault(f"/{-depth}", m.end())
    return [(s, s, 0) if at is None else (s, *run(at)) for s, at in starts.items()] + [("/", "", depth)]


def chain(chunks: list[tuple[int, list[tuple[str, str, int]]]]) -> Iterator[tuple[int, str, int]]:
    """(chunk, state on entry, statements before) of the chunks of a script, in order."""
    state, position = "", 0
    for number, found in chunks:
        yield number, state, position
        known = {s: (after, ends) for s, after, ends in found}
        if state in known:
            state, ends = known[state]
            position += ends
        elif state[0] == "/":
            state = f"/{int(state[1:]) + known['/'][1]}"


def bracket_levels(code: str) -> list[str]:
    """The code without the contents of its brackets, then the contents of each without theirs. () marks what was left out.

    Brackets of functions that may hold the word FROM are no level of their own.
    """
    out, stack, at = [], [], 0
    now: list[str] = []
    for m in re.finditer(r"[()]", code):
        now.append(code[at : m.start()])
        at = m.end()
        if m.group() == "(":
            called = _FROM_INSIDE.search(code, max(0, m.start() - 40), m.start())
            stack.append((now, bool(called)))
            now = []
        elif stack:
            text, (now, silent) = "".join(now), stack.pop()
            if not silent:
                out.append(text)
            now.append(" " if silent else " () ")
    now.append(code[at:])
    while stack:
        text, (now, silent) = "".join(now), stack.pop()
        out.append(text)
        now.append(" () ")
    return ["".join(now), *(x for x in out if x)]


# Functions whose arguments may hold the word FROM.
_FROM_INSIDE = re.compile(r"(?i)\b(?:extract|trim|substring|overlay|position)\s*$")


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]


def _read(backslash: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, *f) for p, sql in zip(batch.column("path").to_pylist(), _texts(batch, "sql"), strict=True) for f in fragments(sql, backslash=backslash)]
            yield _batch(rows, _STATEMENTS)

    return run


def _entered(backslash: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = zip(batch.column("script").to_pylist(), batch.column("chunk").to_pylist(), strict=True)
            yield _batch([(*key, *s) for key, sql in zip(ids, _texts(batch, "sql"), strict=True) for s in steps(sql, backslash)], _STEPS)

    return run


def _chained(table: pa.Table) -> pa.Table:
    found: dict[int, list] = {}
    for r in table.to_pylist():
        found.setdefault(r["chunk"], []).append((r["entry"], r["after"], r["ends"]))
    script = table.column("script")[0].as_py()
    return pa.Table.from_batches([_batch([(script, *c) for c in chain(sorted(found.items()))], _ENTRIES)])


def _read_chunks(backslash: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = ("script", "path", "chunk", "entry", "position")
            rows = []
            for script, path, chunk, entry, position, sql in zip(*[batch.column(c).to_pylist() for c in keys], _texts(batch, "sql"), strict=True):
                rows += [(script, path, chunk, *f) for f in fragments(sql, entry, position, backslash)]
            yield _batch(rows, _PARTS)

    return run


_STATEMENTS = {"path": pa.string(), "position": pa.int32(), "statement": pa.string(), "code": pa.string()}
_STEPS = {"script": pa.int64(), "chunk": pa.int32(), "entry": pa.string(), "after": pa.string(), "ends": pa.int64()}
_ENTRIES = {"script": pa.int64(), "chunk": pa.int32(), "entry": pa.string(), "position": pa.int32()}
_PARTS = {"script": pa.int64(), "path": pa.string(), "chunk": pa.int32(), **{k: _STATEMENTS[k] for k in ("position", "statement", "code")}}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{n} {str(k).replace('int64', 'long').replace('int32', 'int')}" for n, k in kinds.items())


def statements(scripts: DataFrame, backslash: bool = False) -> DataFrame:
    """(path, position, statement, code) of scripts (path, sql): cut at semicolons of the code, blanks folded.

    Statements have no comments; code has ``''`` in place of texts as well. position counts the semicolons before.
    Read are doubled quotes, ``e'..'`` with backslashes (all texts, if ``backslash`` is set), names in double quotes and
    backticks, texts between dollar tags, nested comments and comments up to the line end. What is not closed goes on to
    the script's end. Scripts with equal paths are scripts of their own; a null script has no statements.
    """
    sql, size = F.col("sql"), F.length("sql")
    short = scripts.where(size <= CHUNK).select("path", "sql").mapInArrow(_read(backslash), _ddl(_STATEMENTS))
    out = short.unionByName(_long_statements(scripts.where(size > CHUNK).select("path", sql), backslash)) if _has_long(scripts) else short
    folded = out.withColumns({c: F.trim(F.regexp_replace(c, r"\s+", " ")) for c in ("statement", "code")})
    return folded.where("statement <> ''")


def _has_long(scripts: DataFrame) -> bool:
    return bool(scripts.where(F.length("sql") > CHUNK).take(1))


def _long_statements(scripts: DataFrame, backslash: bool) -> DataFrame:
    pieces = F.regexp_extract_all("sql", F.lit(rf"(?s)(.{{{CHUNK}}}[^\n]*+\n?|.+)"), F.lit(1))
    numbered = scripts.withColumn("script", F.monotonically_increasing_id())
    chunks = numbered.select("script", "path", F.posexplode(pieces).alias("chunk", "sql"))
    chunks = materialise(chunks.repartition("script", "chunk"), "chunks")
    entered = chunks.select("script", "chunk", "sql").mapInArrow(_entered(backslash), _ddl(_STEPS))
    entries = entered.groupBy("script").applyInArrow(_chained, _ddl(_ENTRIES))
    parts = chunks.join(entries, ["script", "chunk"]).mapInArrow(_read_chunks(backslash), _ddl(_PARTS))
    # A statement is as long as it is; its parts are put in order and joined.
    together = parts.groupBy("script", "path", "position").agg(F.array_sort(F.collect_list(F.struct("chunk", "statement", "code"))).alias("parts"))
    return together.select("path", "position", *[F.array_join(f"parts.{c}", "").alias(c) for c in ("statement", "code")])


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        levels = [bracket_levels(c) for c in _texts(batch, "code")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(levels, pa.list_(pa.string()))], names=[*batch.schema.names, "levels"])


def with_levels(code: DataFrame) -> DataFrame:
    """The rows of a table with a column ``code``, and the levels of its brackets."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in code.schema)
    return code.mapInArrow(_levels, f"{kinds}, levels array<string>")
