"""Resume decisions and gap reports at their boundaries."""

from __future__ import annotations

import pytest

from settle.operators import audit

NOW = 1_789_000_000_000_000
S = 1_000_000


@pytest.mark.parametrize(
    ("cursor", "resume", "decision"),
    [
        (None, None, "no cursor"),
        (0, None, "no cursor"),
        (-5, None, "no cursor"),
        (NOW - 10 * S, NOW - 15 * S, "resume"),
        (NOW - 3599 * S, NOW - 3604 * S, "resume"),
        (NOW - 3600 * S, NOW - 3605 * S, "resume"),
        (NOW - 3600 * S - 1, None, "cursor too old"),
        (NOW - 3601 * S, None, "cursor too old"),
        (NOW + 30 * S, NOW + 25 * S, "resume"),
    ],
)
def test_resume(spark, cursor, resume, decision):
    sessions = spark.createDataFrame(
        [(1, cursor, NOW)], "session_id bigint, cursor_us bigint, now_us bigint"
    )
    row = audit.resume_plan(sessions).first()
    assert (row.resume_us, row.decision) == (resume, decision)


@pytest.mark.parametrize(
    ("asked", "first", "gap", "severity"),
    [
        (None, NOW, 0, None),
        (NOW, None, 0, None),
        (NOW, NOW - 5 * S, 0, None),
        (NOW, NOW, 0, None),
        (NOW, NOW + 1 * S, 0, None),
        (NOW, NOW + 9 * S, 0, None),
        (NOW, NOW + 10 * S, 10 * S, "warning"),
        (NOW, NOW + 11 * S, 11 * S, "warning"),
        (NOW, NOW + 600 * S, 600 * S, "warning"),
        (NOW, NOW + 116_640 * S, 116_640 * S, "warning"),
        (NOW, NOW + 116_640 * S + 1, 116_640 * S + 1, "unrecoverable"),
        (NOW, NOW + 2 * 129_600 * S, 2 * 129_600 * S, "unrecoverable"),
    ],
)
def test_gap(spark, asked, first, gap, severity):
    planned = spark.createDataFrame(
        [(1, asked, first)], "session_id bigint, resume_us bigint, first_seen_us bigint"
    )
    row = audit.gap_report(planned).first()
    assert (row.gap_us, row.severity) == (gap, severity)


def test_a_first_frame_that_is_not_usable_gives_no_gap(spark):
    frames = spark.createDataFrame(
        [(1, 2, "usable", NOW + 99 * S), (1, 1, "undeliverable", None), (2, 1, "usable", NOW)],
        "session_id bigint, arrival_order bigint, status string, time_us bigint",
    )
    sessions = spark.createDataFrame(
        [(1, NOW), (2, NOW), (3, NOW)], "session_id bigint, resume_us bigint"
    )
    seen = audit.gap_report(audit.first_seen(frames, sessions))
    assert {(r.session_id, r.first_seen_us, r.gap_us) for r in seen.collect()} == {
        (1, None, 0),
        (2, NOW, 0),
        (3, None, 0),
    }
