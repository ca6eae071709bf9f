"""Transcripts parsed into turns: probes, held-out accuracy, and Viterbi by trying all paths."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackledger.llm import catalog, chat
from trackledger.llm.toxicity import held_out


@pytest.fixture(scope="module")
def known(shared):
    """A stream of lines with true roles, and tables counted outside the held-out fold."""
    lines = chat.stream(chat.shown(shared.read.parquet("/root/testdata/sf0.01/conversations.parquet")))
    return lines, chat.train(lines)


def turns(spark, tables, pieces):
    frame = spark.createDataFrame(pieces, "conv_id long, place long, text string").repartition(3)
    return chat.parse(chat.stream(frame), tables).orderBy("first_line").collect()


def test_turns_inside_one_piece_and_markers_taken_off(shared, known):
    found = turns(shared, known[1], [(1, 0, "hi\nAssistant: hello there\nUser: ok?"), (2, 0, "User: hi")])
    assert [(r["conv_id"], r["role"], r["text"]) for r in found] == [
        (1, "user", "hi"), (1, "assistant", "hello there"), (1, "user", "ok?"), (2, "user", "hi"),
    ]
    assert found[3]["rendered"] == "<|im_start|>user\nhi<|im_end|>\n"


def test_a_turn_goes_on_over_pieces_and_keeps_its_blank_lines(shared):
    """Tables from marked conversations whose texts have blank lines of their own."""
    data = [(c, t, "user" if t % 2 == 0 else "assistant", "First of it.\n\n\nSecond of it.\nthird") for c in range(30) for t in range(4)]
    marked = chat.shown(shared.createDataFrame(data, "conv_id long, turn long, role string, text string"), unmarked=1 << 31)
    tables = chat.train(chat.stream(marked))
    found = turns(shared, tables, [(1, 0, "### Human: First of it.\n\n\nSecond of it.\n"), (1, 1, "third"), (1, 2, "\n\n**Bot**: An answer.\n \n")])
    assert [(r["role"], r["n_lines"], r["text"]) for r in found] == [
        ("user", 3, "First of it.\n\n\nSecond of it.\nthird"), ("assistant", 1, "An answer."),
    ]


def _accuracy(lines, found):
    """(lines with the right role, starts that are starts, starts that are found) of held-out conversations."""
    rows = lines.where("NOT lead").select("g", "role", "begins", held_out(F.col("conv_id"), chat.FOLD).alias("held")).orderBy("g").collect()
    starts = {r["first_line"]: r["role"] for r in found.select("first_line", "role").collect()}
    role, right, hits, begins = None, [], [], []
    for r in rows:
        role = starts.get(r["g"], role)
        if r["held"]:
            right.append(role == r["role"])
            if r["g"] in starts:
                hits.append(r["begins"])
            if r["begins"]:
                begins.append(r["g"] in starts)
    return np.mean(right), np.mean(hits), np.mean(begins), len(begins)


def test_roles_and_turns_of_held_out_conversations(known):
    lines, tables = known
    roles, precision, recall, n = _accuracy(lines, chat.parse(lines, tables))
    assert n > 50 and roles > 0.95 and precision > 0.95 and recall > 0.95


def test_unmarked_turns_are_recovered_from_their_lines(shared):
    """No markers at all: blank lines and the look of lines are what there is."""
    shown = chat.shown(shared.read.parquet("/root/testdata/sf0.01/conversations.parquet"), unmarked=1)
    lines = chat.stream(shown)
    roles, precision, recall, _ = _accuracy(lines, chat.parse(lines, chat.train(lines)))
    assert roles > 0.75 and precision > 0.9 and recall > 0.9


def test_path_is_the_best_of_all(known):
    tables, draw = known[1], np.random.default_rng(4)
    for n in (1, 2, 5):
        lines = [tuple(int(draw.integers(0, size)) for size in chat.SEEN_SIZES) for _ in range(n)]
        seen = tables.seen(lines)

        def score(path, seen=seen):
            steps = zip((chat.START, *path), path, seen)
            return sum(tables.move[a, b] + row[b] for a, b, row in steps)

        best = max(itertools.product(range(chat.STATES), repeat=n), key=score)
        got = tables.path(seen, chat.START)
        assert score(got) == pytest.approx(score(best))
        assert tables.product(seen)[chat.START].max() == pytest.approx(score(best))
        last = int(got[-1])
        assert tables.path(seen, chat.START, last) == got
        for path in itertools.pairwise(got):
            assert path[1] % 2 == 0 or path[0] // 2 == path[1] // 2  # a further line follows its own role


def test_blocks_give_the_path_of_the_whole(shared, known, monkeypatch):
    """Turns over many blocks, also over many blocks of blocks, are what one block makes of them."""
    draw, text = np.random.default_rng(7), []
    for k in range(60):
        style = ["User: ", "", "**Assistant**: ", "", "\n"][int(draw.integers(0, 5))]
        text.append(style + ("Well" if k % 2 else "so") + f" line {k}" + "?." [int(draw.integers(0, 2))])
    pieces = [(5, k, t) for k, t in enumerate(text)] + [(6, 0, "\n".join(text))] + [(7, 0, "one"), (8, 0, None)]
    found = []
    for size in (1024, 7, 3, 1):
        monkeypatch.setattr(chat, "BLOCK", size)
        rows = turns(shared, known[1], pieces)
        found.append([(r["conv_id"], r["first_line"], r["n_lines"], r["role"], r["text"]) for r in rows])
    assert found[0] == found[1] == found[2] == found[3]
    assert [r[2:] for r in found[0] if r[0] == 5] == [r[2:] for r in found[0] if r[0] == 6]


def test_odd_pieces(shared, known):
    pieces = [(1, 0, None), (1, 1, ""), (1, 2, " \n\t"), (None, 0, "User: a"), (None, None, "judge: b\n\nc"), (3, None, "d"), (3, 0, "User: d"), (3, 0, "User: d")]
    pieces += [(4, k, "Bot: x?" if k % 2 else "Q: y") for k in range(3000)] + [(9, 0, "long " * 100_000)]
    found = turns(shared, known[1], pieces)
    by = {}
    for r in found:
        by.setdefault(r["conv_id"], []).append(r)
    assert 1 not in by and set(by) == {None, 3, 4, 9}
    assert "\n".join(r["text"] for r in by[3]) == "d\nd\nd" and len(by[3]) >= 2
    assert by[None][0]["text"].split("\n")[0] == "a" and sum(r["n_lines"] for r in by[None]) == 3
    assert len(by[4]) == 3000 and {r["text"] for r in by[4]} == {"x?", "y"}
    assert by[9][0]["text"] == "long " * 100_000
    empty = shared.createDataFrame([], "conv_id long, place long, text string")
    assert chat.parse(chat.stream(empty), known[1]).isEmpty()
    bare = chat.train(chat.stream(chat.shown(shared.createDataFrame([(1, 0, None, "x")], "conv_id long, turn long, role string, text string"))))
    assert turns(shared, bare, [(1, 0, "User: hi")])[0]["n_lines"] == 1


def test_clashing_columns_are_not_read(shared, known):
    frame = shared.createDataFrame([(1, 0, "User: hi", 1, 2, "b", True, "x")], "conv_id long, place long, text string, g int, block int, line string, lead boolean, role2 string")
    assert [r["text"] for r in chat.parse(chat.stream(frame), known[1]).collect()] == ["hi"]
    conversations = shared.createDataFrame([(1, 0, "user", "hi", 9, "z")], "conv_id long, turn long, role string, text string, place int, shown string")
    assert chat.shown(conversations).columns == ["conv_id", "place", "text", "role"]


def test_query_covers_every_line(shared, sf_dir):
    got = catalog.QUERIES["op7_chat"].run(shared, sf_dir)
    lines = chat.stream(chat.shown(shared.read.parquet(f"{sf_dir}/conversations.parquet"))).where("NOT lead").count()
    assert got.agg(F.sum("n_lines")).first()[0] == lines
    assert got.select("first_line").distinct().count() == got.count()
