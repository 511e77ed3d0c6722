"""Quality rules, quotations and the archive: against SQL, by hand, and on odd rows."""

import hashlib
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acceptance import compare
from tripstats.llm import archive, quality_rules, quotations
from tripstats.llm.oracles import ORACLES
from tripstats.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    tables = compare.connect(FOLDER)
    df = QUERIES[name](spark, FOLDER)
    assert compare.spark_rows(df) == compare.sql_rows(tables, ORACLES[name])


def judged(spark, *texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, kept string")
    return quality_rules.judge(df).orderBy("id").collect()


def test_measures_by_hand(spark):
    text = "A#b c$\n\na b\nx\x0by\na b\n"
    (row,) = judged(spark, text)
    assert (row.n_words, row.word_chars, row.n_symbols) == (8, 11, 2)
    assert (row.n_lines, row.n_dup_lines, row.n_repeat_words) == (4, 1, 0)


def test_repeated_windows(spark):
    once = [f"w{i}" for i in range(9)]
    cases = {
        " ".join(["a"] * 8): 0,
        " ".join(["a"] * 9): 9,
        " ".join(once + ["x"] + once): 18,
        " ".join(once[:8] + ["x"] + once[:7]): 0,
        " ".join(once): 0,
    }
    rows = judged(spark, *cases)
    assert [row.n_repeat_words for row in rows] == list(cases.values())


def test_odd_texts_are_judged(spark):
    long_text = " ".join(f"word{i} the" for i in range(60_000))
    rows = judged(spark, None, "", " \n\t", long_text, "one", "one")
    assert [row.n_words for row in rows] == [0, 0, 0, 120_000, 1, 1]
    assert [row.kept for row in rows] == [False, False, False, True, False, False]
    assert rows[0].failed_rules == ["few_words", "short_words", "stop_words"]
    assert rows[0].symbol_ratio == 0.0


def test_no_rows_and_no_python(spark):
    df = spark.createDataFrame([], "text string, n_words string")
    out = quality_rules.judge(df)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_threshold_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "m double")
    rules = (quality_rules.Rule("low", "m", low=2.0), quality_rules.Rule("high", "m", high=2.0))
    out = df.select("m", quality_rules.passes(rules).alias("ok"), quality_rules.failures(rules).alias("f"))
    assert [tuple(r) for r in out.collect()] == [(1.0, False, ["low"]), (2.0, True, []), (3.0, False, ["high"])]


# --- quotations ------------------------------------------------------------------------


MESSAGES = [
    (1, 0, "a", "Hello there.\nHow are you?"),
    (1, 1, "b", "What is new?"),
    (1, 2, "a", "> hello,  THERE\n>> nothing known\nFine."),
    (1, 3, "b", "> Fine.\n> > Hello there.\n> Hello there.\n> fine\nGood"),
    (1, 4, "a", "> What is new?\nNothing"),
    (1, 5, "b", "> Good\nIndeed"),
    (1, 6, "b", None),
    (2, 0, "a", "> Hello there.\nOther conversation"),
    (2, 0, "a", "> Hello there.\nOther conversation"),
    (2, None, "a", "> Other conversation"),
    (None, 1, "a", "Other conversation"),
]


def linked(spark, rows=MESSAGES):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("thread", F.lit("clash"))
    return quotations.reply_ordered(quotations.link_quotes(df)).collect()


def test_quotes_link_to_their_origin(spark):
    rows = {(r.conv_id, r.turn): r for r in linked(spark)}
    assert len(rows) == 10
    assert rows[1, 2].reply_to == 0 and rows[1, 2].text == "Fine."
    assert (rows[1, 2].n_quotes, rows[1, 2].max_level, rows[1, 2].n_linked) == (2, 2, 1)
    # Two lines of turn 2 against two of turn 0, of which one at level 1.
    assert rows[1, 3].reply_to == 2 and rows[1, 3].n_quotes == 3
    assert (rows[1, 5].reply_to, rows[1, 5].thread, rows[1, 5].depth) == (3, 0, 3)
    assert (rows[1, 4].thread, rows[1, 4].depth) == (1, 1)
    assert rows[1, 6].text == "" and rows[1, 6].thread == 6
    assert rows[2, 0].reply_to is None and rows[2, 0].text == "Other conversation"


def test_conversations_come_in_reply_order(spark):
    turns = [r.turn for r in linked(spark) if r.conv_id == 1]
    assert turns == [0, 2, 3, 5, 1, 4, 6]


def test_long_chain_of_answers(spark):
    rows = [(7, i, "a", f"> line {i - 1}\nline {i}") for i in range(300)]
    found = linked(spark, rows)
    assert [r.depth for r in found] == list(range(300)) and {r.thread for r in found} == {0}


def test_the_message_quoted_most_is_answered(spark):
    rows = [
        (1, 0, "a", "Hello there.\nFine."),
        (1, 4, "b", "Hello there.\nFine.\nNew point"),
        (1, 5, "a", "> Hello there.\n> Fine.\n> New point\nYes"),
        (1, 6, "b", "> Hello there.\n> Other\n> Fine.\nNo"),
    ]
    found = {r.turn: r for r in linked(spark, rows)}
    assert (found[5].reply_to, found[5].n_linked, found[5].thread) == (4, 3, 4)
    # Both hold two lines; the latest wins.
    assert (found[6].reply_to, found[6].n_linked) == (4, 2)


def test_quotes_with_other_line_breaks(spark):
    rows = [
        (1, 0, "a", "The plan is to leave at nine. Bring water and\nbread, and a warm coat."),
        (1, 1, "b", "> bring water and bread,\n> and a warm\n> coat.\nSure"),
        (1, 2, "c", "> Bring water\nToo heavy"),
        (2, 0, "a", "明日は雨です。傘を\n持って行きます。"),
        (2, 1, "b", "> 傘を持って行きます。\nはい"),
        (3, 0, "a", "It is fine."),
        (3, 1, "a", "fine"),
        (3, 2, "b", "fine with me too"),
        (3, 3, "b", "> fine\nGood"),
    ]
    found = {(r.conv_id, r.turn): (r.reply_to, r.n_linked) for r in linked(spark, rows)}
    assert found[1, 1] == (0, 3) and found[1, 2] == (0, 1)
    assert found[2, 1] == (0, 1)
    assert found[3, 3] == (1, 1)


def test_answers_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    lines = ["hi all", "best", "see", "note one", "note two", "so be it", "last thing"]
    rows = []
    for conv in range(3):
        for turn in range(40):
            own = rng.choices(lines, weights=[9, 9, 5, 2, 2, 1, 1], k=rng.randrange(1, 5))
            quoted = rng.choices(lines, weights=[9, 9, 5, 2, 2, 1, 1], k=rng.randrange(0, 5))
            marks = [rng.choice(["> ", "> ", ">> "]) + x for x in quoted]
            rows.append((conv, turn, "a", "\n".join(marks + own)))
    expected = {}
    for conv, turn, _, text in rows:
        runs, votes, n_linked = [], {}, 0
        for line in text.split("\n"):
            marks = len(line) - len(line.lstrip(">"))
            if marks and runs and runs[-1][0] == marks:
                runs[-1][1].append(line[marks:].strip())
            else:
                runs.append((marks, [line[marks:].strip()]))
        before = [
            (t, [x for x in said.split("\n") if x[0] != ">"]) for c, t, _, said in rows if c == conv and t < turn
        ]

        def holders(part):
            n = len(part)
            whole = {t for t, own in before if any(own[i : i + n] == part for i in range(len(own)))}
            text = f" {' '.join(part)} "
            return whole or {t for t, own in before if text in f" {' '.join(own)} "}

        for level, part in runs:
            if level:
                for unit in [part] if holders(part) else [[x] for x in part]:
                    n_linked += len(unit) if holders(unit) else 0
                    for t in holders(unit):
                        direct, n = votes.get(t, (0, 0))
                        votes[t] = (direct + len(unit) * (level == 1), n + len(unit))
        best = max(((*v, t) for t, v in votes.items()), default=(0, 0, None))[2]
        expected[conv, turn] = (best, n_linked)
    assert any(reply is not None for reply, _ in expected.values())
    for limit in (0, 3, 64):
        monkeypatch.setattr(quotations, "HOT_HOLDERS", limit)
        assert {(r.conv_id, r.turn): (r.reply_to, r.n_linked) for r in linked(spark, rows)} == expected


def test_sql_twin_on_quoted_conversations(spark):
    import duckdb

    from tripstats.llm.oracles import ORACLES

    rng = random.Random(12)
    words = ["hi", "all", "best", "See", "note", "one", "two", "so", "be", "it", "雨", "é!"]
    rows = list(MESSAGES)
    for conv in range(3, 9):
        said = []
        for turn in range(30):
            own = [" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(rng.randrange(4))]
            parts = []
            for _ in range(rng.randrange(3)):
                lines = rng.choice(said) if said and rng.random() < 0.7 else [rng.choice(words)]
                if rng.random() < 0.4:  # re-wrapped, or a part of it
                    flat = " ".join(lines).split()
                    flat = flat[rng.randrange(len(flat)):]
                    cut = rng.randrange(len(flat) + 1)
                    lines = [" ".join(flat[:cut]), " ".join(flat[cut:])]
                marks = rng.choice(["> ", ">", ">> ", "> > "])
                parts += [marks + line for line in lines] + rng.choice([[], [""], ["so"]])
            if own:
                said.append(own)
            rows.append((conv, turn - rng.randrange(2), "a", "\n".join(parts + own) if rng.random() < 0.97 else None))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ours = [tuple(r) for r in quotations.link_quotes(df).select(
        "conv_id", "turn", "role", "text", "n_quotes", "max_level", "reply_to", "n_linked", "thread", "depth").collect()]
    conversations = df.toArrow()  # noqa: F841 - the SQL reads it by this name
    theirs = duckdb.connect().execute(ORACLES["op4_quotation_linking"]).fetchall()
    assert sorted(map(repr, ours)) == sorted(map(repr, theirs))
    assert sum(row[6] is not None for row in ours) > 60 and max(row[9] for row in ours) > 3


def test_the_twin_answers_the_message_quoted_most():
    import duckdb

    from tripstats.llm.oracles import ORACLES

    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    for turn, text in ((0, "Hello there.\nFine."), (4, "Hello there.\nFine.\nNew point"),
                       (5, "> Hello there.\n> Fine.\n> New point\nYes")):
        connection.execute("INSERT INTO conversations VALUES (1, ?, 'a', ?)", [turn, text])
    result = connection.execute(ORACLES["op4_quotation_linking"])
    reply = [c[0] for c in result.description].index("reply_to")
    assert sorted((row[1], row[reply]) for row in result.fetchall()) == [(0, None), (4, None), (5, 4)]


def test_no_messages(spark):
    assert linked(spark, []) == []


# --- archive ---------------------------------------------------------------------------

BIG = "é" * 600
PAGES = [
    (1, "http://a", BIG),
    (2, "http://b", BIG),
    (9, "http://c", BIG),
    (3, None, "small"),
    (4, "http://d\r\nX: y", "small"),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "x" * 300_000),
    (9, "http://c", BIG),
]


def archived(spark, tmp_path, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumns({"address": F.lit("clash"), "payload": F.lit(1)})
    path = str(tmp_path / "archive")
    archive.write_archive(df, path)
    return path


def test_archive_round_trip(spark, tmp_path):
    path = archived(spark, tmp_path)
    records = archive.read_records(spark, path).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in records) == sorted(
        (i, (html or "").encode()) for i, _, html in PAGES
    )
    kept = spark.read.parquet(f"{path}/payloads").collect()
    assert len(kept) == 4
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.address for r in kept)


def test_revisits_refer_to_the_largest_id(spark, tmp_path):
    records = archive.read_records(spark, archived(spark, tmp_path))
    refers = archive.page_of(archive.header_field("WARC-Refers-To"))
    rows = records.select("page_id", archive.header_field("WARC-Type"), refers).distinct().collect()
    found = {r[0]: (r[1], r[2]) for r in rows}
    assert found[1] == found[2] == ("revisit", 9)
    assert all(found[i] == ("response", None) for i in (3, 4, 5, 6, 7, 9))


def test_warc_files_hold_the_records(spark, tmp_path):
    records = archive.read_records(spark, archived(spark, tmp_path)).where("page_id in (2, 9, 3)")
    archive.write_warc(records.distinct().coalesce(1).orderBy("page_id"), str(tmp_path / "warc"))
    content = spark.read.format("binaryFile").load(str(tmp_path / "warc")).where("length > 0")
    content = b"".join(bytes(r.content) for r in content.orderBy("path").collect())
    bodies = []
    while content:
        head, _, rest = content.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        length = int(head.rpartition(b"Content-Length: ")[2])
        bodies.append(rest[:length].decode())
        assert rest[length : length + 4] == b"\r\n\r\n"
        content = rest[length + 4 :]
    assert bodies == ["", "small", BIG]


def test_damage_and_missing_ids_stop_the_job(spark, tmp_path):
    path = archived(spark, tmp_path)
    broken = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other"))
    broken.write.parquet(f"{path}/copy/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/copy/records")
    with pytest.raises(PySparkException, match="damaged"):
        archive.read_records(spark, f"{path}/copy").collect()
    with pytest.raises(PySparkException, match="no id"):
        archived(spark, tmp_path / "b", [(None, "u", "x")])


def test_empty_archive(spark, tmp_path):
    assert archive.read_records(spark, archived(spark, tmp_path, [])).count() == 0


def exported(spark, tmp_path, rows=PAGES):
    path = archived(spark, tmp_path, rows)
    archive.export_warc(spark, path, f"{path}/warc")
    return f"{path}/warc"


def test_warc_files_are_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FILE_BYTES", 100_000)
    marks = "a WARC/1.1\r\nContent-Length: 9\r\n\r\n\r\nWARC/1.1\r\n" * 30
    pages = PAGES + [(20, "u", marks), (21, "é|ü", marks), (-3, None, "\n"), (9, "other", "x" * 2000)]
    path = exported(spark, tmp_path, pages)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 1 and all(f.endswith(".gz") for f in files)
    read = archive.read_warc(spark, path)
    assert read.where("record_type = 'revisit' and payload is not null").isEmpty()
    full = archive.full_payloads(read).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in full) == sorted((i, h or "") for i, _, h in pages)
    for row in full:
        assert row.payload_bytes == len(row.payload)
        assert row.payload_digest == hashlib.sha1(bytes(row.payload)).hexdigest()
    types = {(r.page_id, r.record_type, r.refers_to) for r in full}
    assert {(1, "revisit", 9), (2, "revisit", 9), (20, "revisit", 21), (21, "response", None)} <= types
    assert archive.full_payloads(archive.read_warc(spark, path, with_payload=False)).count() == len(pages)


def test_damaged_warc_files_stop_the_job(spark, tmp_path):
    records = archive.read_records(spark, archived(spark, tmp_path)).where("page_id in (3, 7)")
    archive.write_warc(records.coalesce(1), str(tmp_path / "warc"))
    (part,) = [f for f in os.listdir(tmp_path / "warc") if f.startswith("part-")]
    good = (tmp_path / "warc" / part).read_bytes()
    assert archive.read_warc(spark, str(tmp_path / "warc")).count() == 2
    damaged = {
        "digest": good.replace(b"\r\n\r\nsmall", b"\r\n\r\nsmell"),
        "length says": good.replace(b"Content-Length: 5", b"Content-Length: 4"),
        "length says|cut short": good[:-20],
        "no length": good.replace(b"Content-Length: 5", b"Content-Size: 5"),
        "does not begin": good + b"x",
        "cut short": good + b"WARC/1.1\r\nWARC-Type: resp",
    }
    for n, (message, content) in enumerate(damaged.items()):
        folder = tmp_path / f"damaged{n}"
        folder.mkdir()
        (folder / "a.warc").write_bytes(content)
        with pytest.raises(PySparkException, match=message.strip()):
            archive.read_warc(spark, str(folder)).collect()
    whole = archive.read_warc(spark, exported(spark, tmp_path / "c"))
    with pytest.raises(PySparkException, match="does not fit its response"):
        archive.full_payloads(whole.where("page_id <> 9")).collect()


def test_empty_warc(spark, tmp_path):
    assert archive.full_payloads(archive.read_warc(spark, exported(spark, tmp_path, []))).count() == 0
