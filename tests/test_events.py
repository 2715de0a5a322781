import datetime
import gzip
import json
import shutil

import pytest
from pyspark.sql import functions as F

from shapes import plan_of
from tillroll.functions.paths import decoded_path, source_key, source_name
from tillroll.operators.events import (
    dead_files,
    dead_letter_triage,
    event_lines,
    file_stats,
    notification_files,
    rejected_events,
    valid_events,
    validate_events,
)
from tillroll.sinks import events as sinks
from tillroll.sinks.events import (
    NoValidEvents,
    compact_events,
    ingest_events,
    ingest_notified,
    read_dead_letters,
    read_ingest_log,
    read_rejected,
    read_streaming,
)


EVENT = {
    "invoice": "E-9",
    "stockcode": "KETTLE",
    "description": "tea kettle",
    "quantity": 2,
    "price": 19.9,
    "customerid": 512,
    "country": "Japan",
}


def order(**changes):
    """The sample event with some keys changed, or left out where the value is `...`."""
    return {k: v for k, v in {**EVENT, **changes}.items() if v is not ...}


def text(**changes):
    return json.dumps(order(**changes))


def raw(quantity="6", price="19.9", tail="}"):
    return (
        f'{{"invoice":"1","stockcode":"A","customerid":1,"quantity":{quantity},"price":{price}{tail}'
    )


CASES = [
    (text(), None),
    (text(description=...), None),
    (text(extra={"deep": [1, {"x": None}]}), None),
    (text(customerid=None), None),
    (text(invoice=None, stockcode=None), None),
    (text(customerid=...), "missing_fields"),
    (text(quantity=..., price=-1), "missing_fields"),
    (text().replace('"quantity"', '"Quantity"'), "missing_fields"),
    (text(description="caf\u00e9 \u2028 \ud83d\ude00"), None),
    (text().replace("tea kettle", "caf\u00e9"), None),
    (text(quantity=-5), "invalid_quantity"),
    (raw(quantity="-0"), "invalid_quantity"),
    (text(quantity=0), "invalid_quantity"),
    (text(quantity=0, price=0), "invalid_quantity"),
    (text(quantity=0.5), None),
    (text(quantity="6"), "invalid_quantity"),
    (text(quantity=None), "invalid_quantity"),
    (text(quantity=True), None),
    (text(quantity=False), "invalid_quantity"),
    (text(quantity=[6]), "invalid_quantity"),
    (text(quantity={"n": 6}), "invalid_quantity"),
    (text(quantity=10**60), None),
    (text(price=0), "invalid_price"),
    (text(price="19.9"), "invalid_price"),
    (text(price=None), "invalid_price"),
    (text(price=True), None),
    (text(price=1e-30), None),
    (raw(quantity="1e400"), None),
    (raw(quantity="1e-400"), "invalid_quantity"),
    (raw(quantity="6e0"), None),
    (raw(quantity="06"), "malformed_json"),
    (raw(quantity="+6"), "malformed_json"),
    (raw(quantity="NaN"), None),
    (raw(quantity="Infinity"), None),
    (raw(quantity="-Infinity"), "invalid_quantity"),
    (raw(tail=',"price":-1}'), "invalid_price"),
    (raw(price="-1", tail=',"price":3}'), None),
    (raw(tail=',"note":{"a":1,"a":2}}'), None),
    (raw(tail=",}"), "malformed_json"),
    (raw(tail=""), "malformed_json"),
    (raw() + " junk", "malformed_json"),
    (raw() + "}", "malformed_json"),
    (raw() + "}}", "malformed_json"),
    (raw() + "} junk", "malformed_json"),
    (raw() + "]", "malformed_json"),
    (raw() + ',"x":1', "malformed_json"),
    (raw() + ',"events":[' + raw(), "malformed_json"),
    (raw() + '],"x":[' + raw(), "malformed_json"),
    (raw() + '],"events":[' + raw(), "malformed_json"),
    (raw(tail=',"lines":[{"a":1}]}'), None),
    (raw(tail=',"lines":[{"a":1}],"more":[[{}]]}'), None),
    (raw() + "," + raw(), "malformed_json"),
    (raw() + raw(), "malformed_json"),
    (raw() + " // note", "malformed_json"),
    (raw().replace('"', "'"), "malformed_json"),
    (raw(quantity='"a\tb"'), "malformed_json"),
    ("{not valid json at all}", "malformed_json"),
    ("plain words", "malformed_json"),
    ('{"garbage": "no fields"}', "missing_fields"),
    ("{}", "missing_fields"),
    ("[1, 2]", "bad"),
    ('"text"', "bad"),
    ("5", "bad"),
    ("null", "bad"),
    ("true", "bad"),
    ("}", "malformed_json"),
    ("{", "malformed_json"),
]


@pytest.fixture(scope="module")
def judged(spark):
    lines = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(CASES)], "n int, line string")
    return {r.n: r.reason for r in validate_events(lines).collect()}


@pytest.mark.parametrize("n", range(len(CASES)), ids=lambda n: CASES[n][0][:60])
def test_line(judged, n):
    expected = CASES[n][1]
    assert (judged[n] is not None) if expected == "bad" else (judged[n] == expected)


def test_valid_and_rejected_are_all_lines(spark):
    lines = spark.createDataFrame([(line,) for line, _ in CASES], "line string")
    verdicts = validate_events(lines)
    assert valid_events(verdicts).count() + rejected_events(verdicts).count() == len(CASES)


def test_lines_are_stripped_and_blank_ones_dropped(spark):
    lines = spark.createDataFrame([(" a \t",), ("",), (" \t\r",), ("b\r",)], "line string")
    assert [r.line for r in event_lines(lines).collect()] == ["a", "b"]


def test_bytes_that_are_no_utf8(spark, tmp_path):
    path = tmp_path / "bytes.json"
    path.write_bytes(text().encode() + b"\n" + text(description="x").encode().replace(b'"x"', b'"\xff"'))
    from tillroll.sources.events import read_event_lines

    rows = validate_events(read_event_lines(spark, [str(path)])).collect()
    assert [r.reason for r in rows] == [None, "malformed_json"]


def test_file_outcomes(spark):
    rows = [("a", None), ("a", "missing_fields"), ("b", "malformed_json"), ("c", None)]
    stats = file_stats(spark.createDataFrame(rows, "source string, reason string"))
    assert {r.source: (r.n_valid, r.n_bad) for r in stats.collect()} == {
        "a": (1, 1),
        "b": (0, 1),
        "c": (1, 0),
    }
    (dead,) = dead_files(stats).collect()
    assert (dead.source, dead.error_type, dead.error_message, dead.n_lines) == (
        "b",
        "ValidationError",
        "No valid events in b",
        1,
    )


def test_a_line_is_parsed_once_without_python(spark):
    lines = spark.createDataFrame([(text(),)], "line string")
    plan = plan_of(validate_events(lines)).split("== Physical Plan ==")[1]
    assert "Python" not in plan and "Exchange" not in plan
    # The second one stands behind a condition that ordinary lines do not meet.
    assert plan.count("from_json(") == 2


@pytest.mark.parametrize(
    "encoded, key, name",
    [
        ("incoming/test+orders.json", "incoming/test orders.json", "test orders"),
        ("incoming/a%2Bb.json", "incoming/a+b.json", "a+b"),
        ("a.json.json", "a.json.json", "a"),
        ("in.json/x.json", "in.json/x.json", "x"),
    ],
)
def test_notified_keys(spark, encoded, key, name):
    record = {"s3": {"bucket": {"name": "raw"}, "object": {"key": encoded}}}
    sent = spark.createDataFrame([(json.dumps({"Records": [record, record]}),)], "payload string")
    rows = notification_files(sent).collect()
    assert [(r.bucket, r.key, r.source_name) for r in rows] == [("raw", key, name)] * 2


def test_paths(spark):
    paths = ["file:///in/a%20b+c.json", "s3a://raw/x/a%20b+c.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").withColumn("d", decoded_path(F.col("p")))
    rows = df.select("d", source_name(F.col("d")).alias("n"), source_key(F.col("d")).alias("k")).collect()
    assert [r.d for r in rows] == ["file:/in/a b+c.json", "s3a://raw/x/a b+c.json"]
    assert {r.n for r in rows} == {"a b+c"}
    assert len({r.k for r in rows}) == 2


def test_dead_letter_triage(spark):
    message = {
        "timestamp": "2024-05-01T10:03:18Z",
        "requestContext": {
            "requestId": "r1",
            "condition": "RetriesExhausted",
            "approximateInvokeCount": 3,
        },
        "requestPayload": {
            "Records": [
                {
                    "eventName": "Put",
                    "eventTime": "2024-05-01T10:00:00Z",
                    "s3": {"bucket": {"name": "raw"}, "object": {"key": f"in/{n}+x.json", "size": n}},
                }
                for n in (1, 2)
            ]
        },
        "responsePayload": {"errorMessage": "No valid events", "errorType": "ValidationError"},
    }
    rows = dead_letter_triage(
        spark.createDataFrame([(json.dumps(message),)], "message string")
    ).collect()
    assert [(r.key, r.size) for r in rows] == [("in/1 x.json", 1), ("in/2 x.json", 2)]
    assert {(r.request_id, r.attempts, r.seconds_to_dead_letter) for r in rows} == {("r1", 3, 198.0)}


# Ingesting files


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()

    def put(name, *lines):
        path = folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines))
        return str(path)

    return put


def streamed(spark, out):
    return sorted(r.value for r in read_streaming(spark, out).collect())


def test_all_valid_events_are_written(spark, incoming, tmp_path):
    lines = [text(invoice=str(n)) for n in range(3)]
    out, at = str(tmp_path / "out"), datetime.datetime(2024, 3, 5, tzinfo=datetime.timezone.utc)
    result = ingest_events(spark, [incoming("a.json", *lines)], out, arrived_at=at)
    assert result == {"files": 1, "events_written": 3, "events_rejected": 0, "dead_files": 0}
    assert streamed(spark, out) == sorted(lines)
    assert {(r.year, r.month) for r in read_streaming(spark, out).collect()} == {(2024, 3)}
    (folder,) = (tmp_path / "out/lines/outcome=accepted/year=2024/month=3").iterdir()
    assert folder.name.startswith("ingest_batch=")  # not a folder per file


def test_bad_lines_are_kept_aside(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    good = text()
    result = ingest_events(
        spark, [incoming("a.json", good, text(customerid=...), "", "{broken", text(quantity=-5))], out
    )
    assert (result["events_written"], result["events_rejected"]) == (1, 3)
    assert streamed(spark, out) == [good]
    assert sorted(r.reason for r in read_rejected(spark, out).collect()) == [
        "invalid_quantity",
        "malformed_json",
        "missing_fields",
    ]


def test_dead_files(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    paths = [
        incoming("good.json", text()),
        incoming("bad.json", "{}", "x"),
        incoming("empty.json"),
        incoming("blank.json", " ", "", "\t"),
    ]
    result = ingest_events(spark, paths, out)
    assert (result["events_written"], result["dead_files"]) == (1, 3)
    dead = {r.path.split("/")[-1]: r.n_lines for r in read_dead_letters(spark, out).collect()}
    assert dead == {"bad.json": 2, "empty.json": 0, "blank.json": 0}


def test_strict_mode_raises(spark, incoming, tmp_path):
    with pytest.raises(NoValidEvents, match="No valid events in .*bad.json"):
        ingest_events(spark, [incoming("bad.json", "{}")], str(tmp_path / "out"), strict=True)


def test_replay_replaces(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    march = datetime.datetime(2024, 3, 31, 23, tzinfo=datetime.timezone.utc)
    april = march + datetime.timedelta(days=2)
    other = incoming("other.json", text(invoice="9"))
    path = incoming("a.json", text(invoice="1"), text(invoice="2"))
    ingest_events(spark, [path, other], out, arrived_at=march)
    incoming("a.json", text(invoice="3"))
    ingest_events(spark, [path], out, arrived_at=april)
    assert streamed(spark, out) == sorted([text(invoice="3"), text(invoice="9")])
    # Every file counts in the month its newest version arrived.
    months = {r.value: r.month for r in read_streaming(spark, out).collect()}
    assert months == {text(invoice="3"): 4, text(invoice="9"): 3}


def test_only_the_newest_outcome_of_a_file_counts(spark, incoming, tmp_path):
    out = str(tmp_path / "out")

    def state():
        dead = [r.path for r in read_dead_letters(spark, out).collect()]
        return len(streamed(spark, out)), read_rejected(spark, out).count(), len(dead)

    ingest_events(spark, [incoming("a.json", "{}")], out)
    assert state() == (0, 1, 1)
    ingest_events(spark, [incoming("a.json", text(), "{}")], out)
    assert state() == (1, 1, 0)
    ingest_events(spark, [incoming("a.json", "x", "y")], out)
    assert state() == (0, 2, 1)
    assert read_ingest_log(spark, out).count() == 1


def test_missing_and_unreadable_files_are_dead_by_themselves(spark, incoming, tmp_path):
    out, broken = str(tmp_path / "out"), tmp_path / "incoming/broken.json.gz"
    good = [incoming(f"{n}.json", text(invoice=str(n))) for n in range(3)]
    broken.write_bytes(gzip.compress(text().encode() * 1000)[:-20] + b"damage")
    gone = str(tmp_path / "incoming/gone.json")
    result = ingest_events(spark, [*good[:2], gone, str(broken), good[2]], out)
    assert (result["files"], result["events_written"], result["dead_files"]) == (5, 3, 2)
    dead = {r.error_type for r in read_dead_letters(spark, out).collect()}
    assert dead == {"MissingFile", "UnreadableFile"}
    # The missing file arrives after all.
    incoming("gone.json", text(invoice="7"))
    ingest_events(spark, [gone], out)
    assert len(streamed(spark, out)) == 4


@pytest.fixture
def scans(monkeypatch):
    """How often files are scanned: writes of a batch, and the files tried by themselves."""
    counts = {"writes": 0, "tried": []}
    store, read = sinks._store_lines, sinks.read_event_lines

    def storing(*args):
        counts["writes"] += 1
        return store(*args)

    def reading(spark, paths):
        if len(paths) == 1:
            counts["tried"] += paths
        return read(spark, paths)

    monkeypatch.setattr(sinks, "_store_lines", storing)
    monkeypatch.setattr(sinks, "read_event_lines", reading)
    monkeypatch.setattr(sinks, "RETRY_AFTER", (0.0, 0.0))
    return counts


def damaged(path):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text().encode() * 1000)[:-20] + b"damage")
    return str(path)


def test_one_bad_file_costs_one_more_scan(spark, incoming, tmp_path, scans):
    good = [incoming(f"{n}.json", text(invoice=str(n))) for n in range(30)]
    bad = damaged(tmp_path / "incoming/odd [1] a%20b é.json.gz")
    result = ingest_events(spark, [*good[:20], bad, *good[20:]], str(tmp_path / "out"))
    assert (result["events_written"], result["dead_files"]) == (30, 1)
    assert scans["writes"] == 2 and len(set(scans["tried"])) == 1
    assert len(scans["tried"]) == 3


def test_many_bad_files(spark, incoming, tmp_path, scans):
    good = [incoming(f"{n}.json", text(invoice=str(n))) for n in range(6)]
    bad = [damaged(tmp_path / f"incoming/bad{n}.json.gz") for n in range(9)]
    result = ingest_events(spark, [p for pair in zip(good + bad[6:], bad[:6] + bad[:3]) for p in pair], str(tmp_path / "out"))
    assert (result["files"], result["events_written"], result["dead_files"]) == (15, 6, 9)
    assert scans["writes"] <= sinks.NAMED_FAULTS + 2


def test_a_passing_fault_makes_no_dead_letter(spark, incoming, tmp_path, scans, monkeypatch):
    good, late = incoming("a.json", text()), tmp_path / "incoming/late.json.gz"
    damaged(late)

    def wait(seconds):
        if len(scans["tried"]) == 2:
            late.write_bytes(gzip.compress(text(invoice="late").encode()))

    monkeypatch.setattr(sinks, "sleep", wait)
    out = str(tmp_path / "out")
    result = ingest_events(spark, [good, str(late)], out)
    assert (result["events_written"], result["dead_files"]) == (2, 0)
    assert read_dead_letters(spark, out).count() == 0


def test_an_error_that_is_no_files_is_raised_at_once(spark, incoming, tmp_path, scans, monkeypatch):
    def failing(*args):
        scans["writes"] += 1
        raise sinks.PySparkException("no space left")

    monkeypatch.setattr(sinks, "_store_lines", failing)
    with pytest.raises(sinks.PySparkException, match="no space left"):
        ingest_events(spark, [incoming("a.json", text())], str(tmp_path / "out"))
    assert scans["writes"] == 1


def test_a_batch_broken_off_does_not_count(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    ingest_events(spark, [incoming("a.json", text())], out, batch="whole")
    ingest_events(spark, [incoming("b.json", "{}")], out, batch="broken off")
    for folder in (tmp_path / "out/batches").rglob("ingest_batch=broken*"):
        shutil.rmtree(folder)
    assert read_rejected(spark, out).count() == 0 and read_dead_letters(spark, out).count() == 0
    ingest_events(spark, [str(tmp_path / "incoming/b.json")], out, batch="broken off")
    assert read_rejected(spark, out).count() == 1 and read_dead_letters(spark, out).count() == 1


def test_same_batch_twice_changes_nothing(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    paths = [incoming("a.json", text(), "{}"), incoming("bad.json", "x")]
    at = datetime.datetime(2024, 3, 5, tzinfo=datetime.timezone.utc)

    def state():
        readers = (read_streaming, read_rejected, read_ingest_log)
        dead = read_dead_letters(spark, out, today=at.date())
        return [sorted(map(str, r(spark, out).collect())) for r in readers] + [dead.count()]

    ingest_events(spark, paths, out, batch="b", arrived_at=at)
    before = state()
    ingest_events(spark, paths, out, batch="b", arrived_at=at)
    assert state() == before and before[-1] == 1


def test_equal_names_in_two_folders_stay_apart(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    paths = [incoming("a.json", text(invoice="1")), incoming("sub/a.json", text(invoice="2"))]
    ingest_events(spark, paths, out)
    assert streamed(spark, out) == sorted([text(invoice="1"), text(invoice="2")])


@pytest.mark.parametrize("name", ["with space.json", "plus+sign.json", "per%20cent.json", "odd[1]{a}.json"])
def test_odd_file_names(spark, incoming, tmp_path, name):
    out = str(tmp_path / "out")
    result = ingest_events(spark, [incoming(name, text())], out)
    assert (result["events_written"], result["dead_files"]) == (1, 0)
    assert streamed(spark, out) == [text()]


def test_files_named_by_notifications(spark, incoming, tmp_path):
    incoming("test orders.json", text(), text(invoice="2"))
    incoming("sub/a+b.json", text(invoice="3"))
    incoming("not notified.json", text(invoice="4"))
    keys = ["test+orders.json", "sub/a%2Bb.json", "test%20orders.json"]
    records = [{"s3": {"bucket": {"name": "incoming"}, "object": {"key": key}}} for key in keys]
    sent = spark.createDataFrame(
        [(json.dumps({"Records": records[:2]}),), (json.dumps({"Records": records[2:]}),)],
        "payload string",
    )
    out = str(tmp_path / "out")
    result = ingest_notified(spark, sent, out, location=f"{tmp_path}/{{bucket}}/{{key}}")
    assert (result["files"], result["events_written"]) == (2, 3)
    one_by_one = ingest_notified(
        spark, sent, str(tmp_path / "out2"), location=f"{tmp_path}/{{bucket}}/{{key}}", max_files=1
    )
    assert one_by_one == result


def test_old_dead_letters_leave_the_table(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    at = datetime.datetime(2024, 3, 5, tzinfo=datetime.timezone.utc)
    ingest_events(spark, [incoming("bad.json", "{}")], out, arrived_at=at)
    assert read_dead_letters(spark, out, today=datetime.date(2024, 3, 19)).count() == 1
    assert read_dead_letters(spark, out, today=datetime.date(2024, 3, 20)).count() == 0


def outcome(spark, out):
    accepted = [("accepted", r.value, r.year, r.month) for r in read_streaming(spark, out).collect()]
    rejected = [("rejected", r.path, r.line, r.reason) for r in read_rejected(spark, out).collect()]
    dead = [("dead", r.path, r.error_type) for r in read_dead_letters(spark, out).collect()]
    return sorted(accepted + rejected + dead, key=str)


def many_batches(spark, incoming, out):
    paths = [incoming(f"{n}.json", "\n".join([text(invoice=str(n)), "{}"])) for n in range(6)]
    paths.append(incoming("bad.json", "x"))
    for path in paths:
        ingest_events(spark, [path], out)
    return paths


def test_compacted_batches_read_the_same(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    paths = many_batches(spark, incoming, out)
    incoming("0.json", text(invoice="again"))
    ingest_events(spark, paths[:1], out)
    before = outcome(spark, out)
    assert compact_events(spark, out, min_batches=50) == []
    (name,) = compact_events(spark, out, min_batches=3)
    assert outcome(spark, out) == before
    lines = spark.read.parquet(f"{out}/lines").where(f"ingest_batch = '{name}'")
    assert lines.where("line LIKE '%\"0\"%'").count() == 0
    # A file ingested again behind the compaction, and a second compaction over the first.
    incoming("1.json", "{}\n{}")
    ingest_events(spark, paths[1:2], out)
    after = outcome(spark, out)
    assert len(after) == len(before) + 1
    assert any(row[0] == "dead" and row[1].endswith("/1.json") for row in after)
    assert len(compact_events(spark, out, min_batches=2)) == 1
    assert outcome(spark, out) == after
    assert read_ingest_log(spark, out).count() == 7


def test_a_compaction_broken_off_changes_nothing(spark, incoming, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    many_batches(spark, incoming, out)
    before, commit = outcome(spark, out), sinks._commit

    def crash(*args):
        raise OSError("lost")

    monkeypatch.setattr(sinks, "_commit", crash)
    with pytest.raises(OSError):
        compact_events(spark, out, min_batches=2)
    assert outcome(spark, out) == before
    monkeypatch.setattr(sinks, "_commit", commit)
    compact_events(spark, out, min_batches=2)
    assert outcome(spark, out) == before


def test_the_later_batch_wins_whichever_is_written_first(spark, incoming, tmp_path):
    out, path = str(tmp_path / "out"), incoming("a.json", text(invoice="1"))
    days = [datetime.datetime(2024, 3, day, tzinfo=datetime.timezone.utc) for day in (1, 2)]
    ingest_events(spark, [path], out, batch="late", arrived_at=days[1])
    incoming("a.json", text(invoice="2"))
    ingest_events(spark, [path], out, batch="early", arrived_at=days[0])
    (row,) = read_streaming(spark, out).collect()
    assert row.value == text(invoice="1")
    ingest_events(spark, [path], out, batch="late", arrived_at=days[1])
    (row,) = read_streaming(spark, out).collect()
    assert row.value == text(invoice="2")


def test_events_are_read_without_the_log(spark, incoming, tmp_path):
    out = str(tmp_path / "out")
    many_batches(spark, incoming, out)
    plan = read_streaming(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "ingest_log" not in plan and "max_by" not in plan and "HashAggregate" not in plan
