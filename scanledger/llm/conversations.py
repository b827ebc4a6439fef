"""Repair of the structure of conversations by a grammar-compressed dynamic program.

Every row of a conversation becomes one symbol of its role and fault. Re-Pair
rules, learned over the sequences of all conversations, stand for frequent runs
of symbols. A symbol is a min-plus matrix: for each state before and after it,
the least cost and the least audit string of edits. Matrices of rules are made
once, bottom-up, from those of their two parts, and serve all conversations; a
conversation is the product of the few matrices of its compressed sequence.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import ASCII_SPACE, batches, stored

NULL_TEXT = " "
#: Damage of the contract: one row in so many is dropped, emptied, cut, repeated or given to the user.
DAMAGE_EVERY = 20

#: Bounds of the grammar; beyond them sequences stay longer, with the same results.
RULE_ROUNDS = 6
ROUND_RULES = 32
#: A pair must occur so often to become a rule.
RULE_COUNT = 4
#: Compressed sequences whose result a task remembers.
REMEMBERED = 1 << 14

#: Symbols: rows to be deleted, then the role's initial for sound rows and in upper case for truncated ones.
DELETED = "-"
ROLES = "sua"
OTHER = "o"
TERMINALS = DELETED + ROLES + OTHER + (ROLES + OTHER).upper()
FIRST_RULE = 0x100


# --- rows and faults -------------------------------------------------------------------------


def _ids() -> list[Column]:
    return [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, and ``dropped`` rows marked.

    By the unsigned crc32 of ``conv_id:turn`` modulo ``DAMAGE_EVERY``: 0 drops
    the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it
    adjacently, 4 gives it to the user. Nulls of all columns read as one space.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in ("conv_id", "turn")))
    way = F.crc32(F.encode(name, "UTF-8")) % DAMAGE_EVERY
    filled = rows.select(
        *_ids(), *(F.coalesce(F.col(c), F.lit(NULL_TEXT)).alias(c) for c in ("role", "text")), way.alias("way")
    )
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("way") == 3, 2).otherwise(1)
    role = F.when(F.col("way") == 4, "user").otherwise(F.col("role"))
    return filled.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("way") == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def undamaged(rows: DataFrame) -> DataFrame:
    """The rows as they are, in the form of ``damage``."""
    return rows.select(
        *_ids(), *(F.coalesce(F.col(c), F.lit(NULL_TEXT)).alias(c) for c in ("role", "text")),
        F.lit(False).alias("dropped"),
    )


def _digest() -> Column:
    return F.unhex(F.md5(F.encode("text", "UTF-8")))


#: Rows of a conversation: by turn, nulls first; equal turns by role and a digest of the text.
_ORDER = ("turn", "role", "digest")


def row_symbols(rows: DataFrame) -> DataFrame:
    """One narrow row per row: its place in the order, role initial, ``fault`` and ``symbol``.

    Faults, the first one counts: ``blank``, ``duplicate`` (role and text are
    those of an earlier row of the conversation), ``truncated`` (the last
    character but white space is none of ``.!?``). Copies of one text are
    ranked by Spark, so a conversation of very many rows isn't held anywhere.
    """
    bare = F.rtrim("text", F.lit(ASCII_SPACE.decode()))
    narrow = rows.select(
        "conv_id", "turn", "role", "dropped", _digest().alias("digest"),
        (F.length(bare) == 0).alias("blank"), (~F.substr(bare, F.lit(-1)).isin(".", "!", "?")).alias("open"),
    )
    copies = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.asc_nulls_first("turn"))
    seen = narrow.withColumn("rank", F.row_number().over(copies))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("rank") > 1, "duplicate").when(F.col("open"), "truncated")
    )
    initial = F.substr("role", F.lit(1), F.lit(1))
    kind = F.when(initial.isin(*ROLES), initial).otherwise(OTHER)
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), DELETED)
        .when(F.col("fault") == "truncated", F.upper("kind"))
        .otherwise(F.col("kind"))
    )
    return seen.select(
        "conv_id", "turn", "role", "digest", "dropped", fault.alias("fault"), kind.alias("kind")
    ).withColumn("symbol", symbol)


_FAULTS = ("blank", "duplicate", "truncated")
_COUNTS = ("gaps", *_FAULTS, "illegal")
_SEQUENCES = pa.schema([("conv_id", pa.int64()), ("symbols", pa.string()), *((c, pa.int64()) for c in _COUNTS)])
SEQUENCES = "conv_id long, symbols string, " + ", ".join(f"{c} long" for c in _COUNTS)
_NONE = object()


@dataclass
class _Conversation:
    """What a task holds of the conversation whose rows it reads: symbols and counts."""

    symbols: list[str] = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)
    first: int | None = None
    last: int | None = None
    turns: int = 0
    kind: str = ""

    def add(self, turn: int | None, kind: str, fault: str | None, symbol: str) -> None:
        self.symbols.append(symbol)
        if fault:
            self.counts[fault] += 1
        self.counts["illegal"] += bool(self.kind) and self.kind + kind not in ("su", "ua", "au")
        self.kind = kind
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn

    def row(self, conv_id: int | None) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (conv_id, "".join(self.symbols), gaps, *(self.counts[c] for c in (*_FAULTS, "illegal")))


def _join_symbols(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sequences() -> Iterator[tuple]:
        at, held = _NONE, _Conversation()
        for part in parts:
            columns = (part.column(c).to_pylist() for c in ("conv_id", "dropped", "turn", "kind", "fault", "symbol"))
            for conv_id, dropped, *row in zip(*columns, strict=True):
                if conv_id != at:
                    if at is not _NONE:
                        yield held.row(at)
                    at, held = conv_id, _Conversation()
                if not dropped:
                    held.add(*row)
        if at is not _NONE:
            yield held.row(at)

    yield from batches(sequences(), _SEQUENCES)


def conversation_sequences(rows: DataFrame) -> DataFrame:
    """One row per conversation: its ``symbols`` in order, and the counts of its faults.

    ``gaps`` is the largest less the smallest turn plus one less the distinct
    turns, without nulls; 0 if all are null. ``illegal`` counts adjacent rows
    whose role initials are not su, ua or au. A conversation whose rows are all
    dropped has no symbols and zeros. Rows without an id are one conversation.
    """
    ordered = row_symbols(rows).repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", *(F.asc_nulls_first(c) for c in _ORDER))
    return ordered.mapInArrow(_join_symbols, SEQUENCES)


# --- min-plus matrices -----------------------------------------------------------------------


class Rope:
    """An audit string as a tree of shared parts."""

    __slots__ = ("left", "right", "size", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        if self.size + other.size <= 16:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def leaves(self) -> Iterator[str]:
        waiting = [self]
        while waiting:
            rope = waiting.pop()
            if rope.left is None:
                yield rope.text
            else:
                waiting += (rope.right, rope.left)

    def __str__(self) -> str:
        return self.text if self.left is None else "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        while self.left is not None and self.left is other.left:
            self, other = self.right, other.right  # noqa: PLW0642 - a shared beginning decides nothing
        return self is not other and str(self) < str(other)


#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What a row of each role does to the states.
_MOVES = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    OTHER: {},
}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of the edits.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

Entry = tuple[int, Rope]
Matrix = tuple[tuple[Entry | None, ...], ...]


def _least(entries) -> Entry | None:
    """The cheapest entry; of equally cheap ones the least string.

    Equally cheap strings between the same states are never one the beginning
    of the other, as the rest would be insertions and cost more. So the order of
    two of them stays the same whatever follows, and products may be taken in
    any grouping.
    """
    best = None
    for entry in entries:
        if entry is not None and (best is None or entry[0] < best[0] or (entry[0] == best[0] and entry[1] < best[1])):
            best = entry
    return best


def product(one: Matrix, two: Matrix) -> Matrix:
    """First ``one``, then ``two``."""

    def through(start: int, end: int) -> Entry | None:
        ways = ((one[start][m], two[m][end]) for m in STATES)
        return _least((x[0] + y[0], x[1] + y[1]) for x, y in ways if x and y)

    return tuple(tuple(through(i, j) for j in STATES) for i in STATES)


def _insertions() -> Matrix:
    """Any number of inserted rows."""
    none: Entry = (0, Rope())
    once = [[None] * 4 for _ in STATES]
    for role in "ua":
        for i, j in _MOVES[role].items():
            once[i][j] = (INSERT_COST, Rope(INSERT))
    for i in STATES:
        once[i][i] = none
    step = tuple(map(tuple, once))
    return product(product(step, step), step)


INSERTIONS = _insertions()


def terminal(symbol: str) -> Matrix:
    """Insertions in front of a row, and one edit of the row."""
    edits = [[[] for _ in STATES] for _ in STATES]
    for i in STATES:
        edits[i][i].append((DELETE_COST, Rope(DELETE)))
    if symbol != DELETED:
        more = TRUNCATED_COST if symbol.isupper() else 0
        for i, j in _MOVES[symbol.lower()].items():
            edits[i][j].append((more, Rope(KEEP)))
        for role in "ua":
            for i, j in _MOVES[role].items():
                edits[i][j].append((REROLE_COST + more, Rope(REROLE)))
    return product(INSERTIONS, tuple(tuple(_least(e) for e in row) for row in edits))


@dataclass
class Grammar:
    """Re-Pair rules in the order they were made, and a matrix for every symbol."""

    rules: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.matrices = {s: terminal(s) for s in TERMINALS}
        for at, pair in enumerate(self.rules):
            self.matrices[chr(FIRST_RULE + at)] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self.known: dict[str, tuple[int, str]] = {"": (0, "")}

    def compress(self, symbols: str) -> str:
        for at, pair in enumerate(self.rules):
            if len(symbols) < 2:
                break
            symbols = symbols.replace(pair, chr(FIRST_RULE + at))
        return symbols

    def _whole(self, symbols: str) -> Matrix:
        matrices = [self.matrices[s] for s in symbols]
        while len(matrices) > 1:
            rest = matrices[len(matrices) // 2 * 2 :]
            matrices = [product(*pair) for pair in zip(matrices[::2], matrices[1::2], strict=False)] + rest
        return matrices[0]

    def audit(self, symbols: str) -> tuple[int, str]:
        """The least cost of a sequence and the least audit string of that cost."""
        short = self.compress(symbols)
        if short not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known = {"": (0, "")}
            ends = product(self._whole(short), INSERTIONS)[START]
            cost, rope = _least((ends[START], ends[ASSISTANT]))
            found = (cost, str(rope))
            if len(short) > 64:
                return found
            self.known[short] = found
        return self.known[short]


# --- grammar ---------------------------------------------------------------------------------

_PAIRS = pa.schema([("pair", pa.string()), ("seen", pa.int64())])


def _count_pairs(rules: list[str]):
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, seen = Grammar(rules), Counter()
        for part in parts:
            both = zip(part.column("symbols").to_pylist(), part.column("n").to_pylist(), strict=True)
            for symbols, n in both:
                short = grammar.compress(symbols)
                for pair in map(str.__add__, short, short[1:]):
                    seen[pair] += n
        yield from batches(seen.items(), _PAIRS)

    return count


def fit_grammar(
    sequences: DataFrame, rounds: int = RULE_ROUNDS, round_rules: int = ROUND_RULES, least: int = RULE_COUNT
) -> Grammar:
    """Re-Pair over all sequences: the most frequent adjacent pairs become symbols, round by round.

    A round counts the pairs of all sequences, each distinct one once, and takes
    the most frequent pairs that share no symbol, so that they can be replaced
    in any order. The driver sees counts of pairs of symbols, at most the square
    of the number of symbols, whatever the size of the table.
    """
    distinct = sequences.filter(F.length("symbols") > 1).groupBy("symbols").agg(F.count("*").alias("n"))
    distinct = stored(distinct, "symbols")
    rules: list[str] = []
    for _ in range(rounds):
        counted = distinct.mapInArrow(_count_pairs(list(rules)), "pair string, seen long")
        counted = counted.groupBy("pair").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= least)
        used: set[str] = set()
        chosen = []
        for row in sorted(counted.collect(), key=lambda r: (-r.seen, r.pair)):
            if len(chosen) < round_rules and not used & set(row.pair):
                used |= set(row.pair)
                chosen.append(row.pair)
        if not chosen:
            break
        rules += chosen
    return Grammar(rules)


_AUDITS = pa.schema([*_SEQUENCES, ("cost", pa.int64()), ("audit", pa.string())])


def _audit_rows(rules: list[str]):
    def audit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for part in parts:
            found = [grammar.audit(s) for s in part.column("symbols").to_pylist()]
            columns = [*part.columns, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found])]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema=_AUDITS)

    return audit


def audits(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """The sequences with ``cost`` and ``audit``, the cheapest edits' initials in order.

    Keep (K) costs 0, Rerole (R) to user or assistant 2, Delete (D) 3, required
    for blank and duplicate rows, Insert (I) of an empty user or assistant row 2;
    a truncated row that stays adds 1. The roles' initials then read
    ``(s?(ua)+)?``. Of equally cheap edits the least string in ASCII.
    """
    return sequences.mapInArrow(_audit_rows(grammar.rules), f"{SEQUENCES}, cost long, audit string")


# --- repaired rows ---------------------------------------------------------------------------


def _edited(rows: Iterator[tuple], audit: str) -> Iterator[tuple[str, str, str]]:
    """``edit, role, text`` of each row that stays or comes; the audit fixes all roles."""
    last = ""
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        yield edit, role, text


def _conversations(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple]]]:
    """Each conversation's audit row, and its rows as they are read."""

    def rows() -> Iterator[tuple]:
        for part in parts:
            names = ("conv_id", "found", "role", "text")
            yield from zip(*(part.column(c).to_pylist() for c in names), strict=True)

    coming = rows()
    ahead = next(coming, None)

    def own() -> Iterator[tuple]:
        nonlocal ahead
        while ahead is not None and ahead[1] is None:
            row, ahead = ahead, next(coming, None)
            yield row[2:]

    while ahead is not None:
        head, ahead = ahead, next(coming, None)
        body = own()
        yield {"conv_id": head[0], **head[1]}, body
        for _ in body:
            pass


_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)
_FOUND = (*_COUNTS, "cost", "audit")
_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), *((c, pa.int64()) for c in (*_COUNTS, "cost")), ("audit", pa.string()),
     ("repaired_sha256", pa.string())]
)


def _repair(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def repaired() -> Iterator[tuple]:
        for found, rows in _conversations(parts):
            for place, row in enumerate(_edited(rows, found["audit"])):
                yield (found["conv_id"], place, *row)

    yield from batches(repaired(), _REPAIRED, 256)


def _hash_repaired(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests() -> Iterator[tuple]:
        for found, rows in _conversations(parts):
            digest, between = hashlib.sha256(), b""
            for _, role, text in _edited(rows, found["audit"]):
                digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                between = b"\n"
            yield (found["conv_id"], *(found[c] for c in _FOUND), digest.hexdigest())

    yield from batches(digests(), _DIGESTS)


def _with_audits(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of each conversation in order, after a row that holds its audit."""
    own = rows.filter(~F.col("dropped")).select(
        "conv_id", "turn", "role", "text", _digest().alias("digest"),
        F.lit(None).cast(_found_type()).alias("found"),
    )
    heads = audited.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"),
        F.struct(*_FOUND).cast(_found_type()).alias("found"),
    )
    both = heads.unionByName(own).withColumn("kind", F.col("found").isNull()).repartition("conv_id")
    order = ("conv_id", "kind", *(F.asc_nulls_first(c) for c in _ORDER))
    return both.sortWithinPartitions(*order).select("conv_id", "found", "role", "text")


def _found_type() -> str:
    return "struct<" + ", ".join(f"{c}: bigint" for c in (*_COUNTS, "cost")) + ", audit: string>"


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations, in order within a task."""
    schema = "conv_id long, place long, edit string, role string, text string"
    return _with_audits(rows, audited).mapInArrow(_repair, schema)


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The audited sequences with ``repaired_sha256`` of ``role:text`` lines, hashed row by row.

    The hash of a conversation goes over its rows one after the other, so they
    pass through one task; none of them is held.
    """
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in (*_COUNTS, "cost")) + ", audit string, repaired_sha256 string"
    return _with_audits(rows, audited).mapInArrow(_hash_repaired, schema)


def repair_conversations(rows: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """``conv_id, symbols``, counts, ``cost`` and ``audit`` of rows as ``damage`` or ``undamaged`` give them.

    With :func:`repaired_rows` they give the repaired conversations. Rows that
    repeat are duplicates; ties of turn go by role, then a digest of the text;
    an empty table gives no rows; only ``conv_id, turn, role, text`` are read.
    """
    sequences = stored(conversation_sequences(rows), "sequences")
    return stored(audits(sequences, grammar or fit_grammar(sequences)), "audits")
