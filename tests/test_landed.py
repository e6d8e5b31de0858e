"""Facts from landed payloads, on literal rows."""

from pyspark.sql import functions as F

from deliverylens.operators import review, tracker
from deliverylens.sources import journal


def ts(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in ("at", "merged_at", "created_at", "started_at", "ended_at", "executed_at", "first_review_at") else F.col(c) for c in df.columns])


def test_reviews_leave_out_authors_and_bots(spark):
    prs = spark.createDataFrame([(1, "ann"), (2, "bob")], "pr_id int, author string")
    acts = [(1, "comment", "2026-01-01 09:00", "ann", None), (1, "comment", "2026-01-01 09:30", "ci-bot", None), (1, "comment", "2026-01-01 10:00", "cy", None), (1, "approval", "2026-01-01 12:00", "cy", None), (1, "changes_requested", "2026-01-01 11:00", None, None), (1, "update", "2026-01-01 08:00", "ann", "OPEN"), (1, "update", "2026-01-01 13:00", "ann", "DECLINED"), (1, "update", "2026-01-01 14:00", "ann", "OPEN")]
    got = {r.pr_id: r for r in review.review_timeline(prs, ts(spark, acts, "pr_id int, kind string, at string, user string, state string")).collect()}
    one = got[1]
    assert (str(one.first_review_at), one.first_reviewer, one.reviewer_count, one.approvals, one.revisions, one.reopens) == ("2026-01-01 10:00:00", "cy", 1, 1, 1, 1)
    assert one.actions["cy"] == "approved" and got[2].first_review_at is None and got[2].reviewer_count == 0


def test_comments_diffs_and_commits(spark):
    prs = spark.createDataFrame([(1, "ann")], "pr_id int, author string")
    comments = spark.createDataFrame([(1, "ann", True, False), (1, "cy", False, False), (1, "cy", True, True), (1, "svc-build", True, False)], "pr_id int, user string, inline boolean, deleted boolean")
    c = review.comment_summary(prs, comments).first()
    assert (c["inline"], c.top_level, c.by_author, c.by_bots, c.deleted, c.by_person) == (1, 1, 1, 1, 1, {"ann": 1, "cy": 1})
    files = spark.createDataFrame([(1, "added", 5, 0, None, "x/a.feature"), (1, "modified", 2, 1, "b.steps.ts", "b.steps.ts"), (1, "removed", 0, 9, "src/c.go", None)], "pr_id int, status string, lines_added int, lines_removed int, old_path string, new_path string")
    d = review.diffstat_summary(files).first()
    paths = {"features/step-definitions/enforcementRule.steps.ts": "step_definition", "tests/login.spec.ts": "spec", "test_api.py": "spec", "src/pages/LoginPage.ts": "page_object", "tests/data/payload.json": "fixture", "package.json": None, "src/utils/helper.ts": None}
    assert {r.p: r.k for r in spark.createDataFrame([(x,) for x in paths], "p string").select("p", review.first_match(F.col("p"), review.AUTOMATION_KINDS).alias("k")).collect()} == paths
    assert (d.lines_added, d.lines_removed, d.files_changed, d.scripts_added, d.scripts_modified) == (7, 10, 3, 1, 1) and d.files_by_kind["feature"].added == 1
    commits = ts(spark, [(1, "s2", "2026-01-02 00:00", "r1", True), (1, "s1", "2026-01-01 00:00", "r1", False), (1, "s3", "2026-01-03 00:00", None, False)], "pr_id int, sha string, at string, run_id string, marked boolean")
    s = review.commit_summary(commits).first()
    assert (s.commit_count, s.ai_commits, s.run_ids, s.shas) == (3, 1, ["r1"], ["s1", "s2", "s3"])
    links = spark.sql("SELECT array('r1') r, true m, 'K-1' k UNION ALL SELECT array('a', 'b'), true, null UNION ALL SELECT array(), true, 'K-1' UNION ALL SELECT array(), false, 'K-1' UNION ALL SELECT null, false, null")
    assert [tuple(x.l) for x in links.select(review.link(F.col("r"), F.col("m"), F.col("k")).alias("l")).collect()] == [("explicit", 1.0, "r1"), ("explicit", 1.0, None), ("marker_only", 0.3, None), ("heuristic", 0.5, None), (None, 0.0, None)]


def test_reverts_are_paired_in_order_of_evidence(spark):
    full = "a" * 40
    merges = ts(spark, [(1, "x", "2026-01-01", full, "add a"), (2, "x", "2026-01-02", "b" * 40, "add b"), (3, "x", "2026-01-05", "c" * 40, "add b"), (4, "y", "2026-01-01", "d" * 40, "add d")], "pr_id int, repo string, merged_at string, sha string, subject string")
    reverts = ts(spark, [("r1", "x", "2026-01-03", full, "z"), ("r2", "x", "2026-01-03", "b" * 9, "z"), ("r3", "x", "2026-01-04", None, "add b"), ("r4", "x", "2026-01-04", None, "add d")], "revert_id string, repo string, at string, sha string, subject string")
    assert {r.revert_id: (r.pr_id, r.how, r.days) for r in review.pair_reverts(reverts, merges).collect()} == {"r1": (1, "sha", 2.0), "r2": (2, "prefix", 1.0), "r3": (2, "subject", 2.0), "r4": (None, "unresolved", None)}
    commits = ts(spark, [(1, "2026-01-02", 5), (1, "2026-01-04", 7), (2, "2026-01-02", None), (3, "2026-01-02", 1)], "pr_id int, at string, lines int")
    times = ts(spark, [(1, "2026-01-03"), (2, "2026-01-01"), (3, None)], "pr_id int, first_review_at string")
    assert {r.pr_id: r.lines_after_review for r in review.review_churn(commits, times).collect()} == {1: 7, 2: None, 3: None}


def test_issues_tests_and_builds(spark):
    links = [("A-1", 0, "A-2", "relates to"), ("A-1", 1, "B-9", "Implements"), ("A-3", 0, "A-4", "blocks"), ("A-5", 0, "A-6", "duplicates"), ("A-5", 1, "A-7", " Tests"), ("A-8", 0, "A-9", "clones"), ("A-10", 0, "B-1", "tests"), ("A-11", 0, "A-1", "tests")]
    parents = [("A-1", "A-100"), ("A-3", "B-7"), ("A-5", None), ("A-8", None), ("A-10", "C-1"), ("A-11", "A-5"), ("A-12", "A-13"), ("A-14", None)]
    got = tracker.attributed_issue(spark.createDataFrame(parents, "issue_key string, parent_key string"), spark.createDataFrame(links, "issue_key string, nth int, target_key string, link_type string"))
    assert {r.issue_key: (r.target_key, r.confidence) for r in got.collect()} == {
        "A-1": ("B-9", 0.7), "A-3": ("B-7", 0.6), "A-5": ("A-7", 0.4), "A-8": ("A-9", 0.2), "A-10": ("C-1", 0.7), "A-11": ("A-1", 0.4), "A-12": ("A-13", 0.5), "A-14": (None, 0.0),
    }
    issues = ts(spark, [("A-1", "2026-01-01", "Done"), ("A-2", "2026-01-01", "Open")], "issue_key string, created_at string, status string")
    changes = ts(spark, [("A-1", "2026-01-02", "status", "Open", "Done"), ("A-1", "2026-01-02", "assignee", "x", "y")], "issue_key string, at string, field string, from_value string, to_value string")
    got = sorted((r.issue_key, r.from_status or "", r.to_status, r.age_ms) for r in tracker.status_transitions(issues, changes).collect())
    assert got == [("A-1", "", "Open", 0), ("A-1", "Open", "Done", 86_400_000), ("A-2", "", "Open", 0)]
    runs = ts(spark, [("Passed", "2026-01-01", ["d"]), ("Not Run", "2026-01-01", None), ("odd", "2026-01-01", [])], "status string, executed_at string, defects array<string>")
    assert [(r.status_category, r.executed_at is None, r.defect_count) for r in tracker.test_runs(runs).collect()] == [("passed", False, 1), ("not_run", True, 0), ("other", False, 0)]
    builds = ts(spark, [(1, "SUCCESSFUL", "2026-01-01 00:00:00", "2026-01-01 00:01:00", '{"total": 10, "failed": 1, "skipped": 2}'), (2, "FAILURE", "2026-01-01 00:01:00", "2026-01-01 00:00:00", '{"passCount": 3, "failCount": 1}'), (3, "x", None, None, None)], "build_id int, state string, started_at string, ended_at string, report string")
    assert [tuple(r) for r in tracker.build_events(builds).collect()] == [(1, "success", 60000, 10, 1, 2, 7), (2, "failed", None, 4, 1, None, 3), (3, "running", None, None, None, None, None)]


def test_journals_chats_and_git(spark, tmp_path):
    import os

    os.makedirs(tmp_path / "ses1")
    (tmp_path / "ses1" / "events.jsonl").write_text('{"type": "tool.start", "timestamp": "2026-01-01T00:00:00Z", "data": {"id": 1}}\n{"type": "tool.end", "timest')
    assert [(r.session_id, r.kind, r.data) for r in journal.read_journal(spark, str(tmp_path)).collect()] == [("ses1", "tool.start", '{"id":1}')]
    patches = spark.createDataFrame([("s", "q1", 1, "a", None), ("s", "q1", 2, None, 5), ("s", "q1", 3, "b", None)], "session_id string, request_id string, line_no int, model string, tokens int")
    assert [(r.model, r.tokens) for r in journal.merge_chat(patches).collect()] == [("b", 5)]
    history = spark.createDataFrame([('{"ts": 1767225600, "cmd": "git status", "exit_code": 0}',), ('{"timestamp": "2026-01-01T00:00:00Z", "command": "/bin/x y"}',)], "value string")
    assert [(str(r["at"]), r.program) for r in journal.tool_history(history).collect()] == [("2026-01-01 00:00:00", "git"), ("2026-01-01 00:00:00", None)]
    log = journal.git_log(spark.createDataFrame([("abc|ann|2026-01-01T00:00:00+0000|subject\n\nRun-Id: r1\nrun-id: r2",)], "value string")).first()
    assert (log.sha, log.subject, log.trailers) == ("abc", "subject", {"run-id": "r2"})
    ref = spark.createDataFrame([("x", 1, "checkout: moving from main to feat/a"), ("x", 2, "commit: y"), ("x", 3, "checkout: moving from a to " + "0" * 40)], "repo string, at int, message string")
    assert [tuple(r) for r in journal.branch_timeline(ref).collect()] == [("x", 1, "feat/a")]
