"""Rules that the driver fixtures can't show: deep trees, cycles, changing folders, late events."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kaiji import fs
from kaiji.operators import hierarchy as H
from kaiji.operators import verdict as V
from kaiji.plans import registry
from kaiji.plans.tables import view
from kaiji.session import work_dir
from kaiji.sinks import tables as K
from kaiji.sources import files as S
from kaiji.sources import xbrl as X
from kaiji.streaming import changes as C
from kaiji.streaming import jobs as J

CHAIN = [(f"k{i:02d}", f"k{i + 1:02d}", "r", 1.0) for i in range(40)]
CYCLE = [("a", "b", "r", 1.0), ("b", "c", "r", 1.0), ("c", "a", "r", 1.0), ("top", "a", "r", 1.0), ("s", "s", "r", 1.0)]
EDGES = "parent_key string, child_key string, role string, child_order double"


def test_descendants_reach_every_level(spark):
    got = {(r["key"], r["descendant"]): r["depth"] for r in H.descendants(spark.createDataFrame(CHAIN, EDGES)).collect()}
    assert got == {(f"k{i:02d}", f"k{j:02d}"): j - i for i in range(41) for j in range(i + 1, 41)}


def test_cycles_end(spark):
    got = {(r["key"], r["descendant"]) for r in H.descendants(spark.createDataFrame(CYCLE, EDGES)).collect()}
    ring = {(x, y) for x in "abc" for y in "abc"}
    assert got == ring | {("top", x) for x in "abc"} | {("s", "s")}


def test_top_ancestors_and_order_of_deep_and_cyclic_trees(spark):
    tops = {r["key"]: r["top_key"] for r in H.top_ancestors(spark.createDataFrame(CHAIN, EDGES)).collect()}
    assert tops == {f"k{i:02d}": "k00" for i in range(41)}
    tops = {(r["key"], r["top_key"]) for r in H.top_ancestors(spark.createDataFrame(CYCLE, EDGES)).collect()}
    assert tops == {(x, "top") for x in ("a", "b", "c", "top")}
    for edges, n in ((CHAIN, 40), (CYCLE, 3)):
        df = spark.createDataFrame(edges, EDGES)
        wanted = df.select(F.col("child_key").alias("key")).distinct()
        rows = H.display_order(df, wanted, "r").collect()
        assert max(r["lvl"] for r in rows) == n and len(rows) == n


def test_first_arc_and_first_label_stay(spark):
    calc = spark.createDataFrame([("p", "c", 1.0, 3.0), ("p", "c", -1.0, 9.0), ("p", "d", 5.0, 1.0)],
                                 "parent_key string, child_key string, weight double, pos double")
    assert {(r["child_key"], r["weight"]) for r in H.first_calc_edges(calc).collect()} == {("c", 1.0), ("d", 5.0)}


def _zip(path, **files):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, text in files.items():
            z.writestr(f"XBRL/PublicDoc/{n}", text)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def _instance(value):
    return ('<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:t="http://e/t"><x:context id="c"><x:period><x:instant>2024-01-01</x:instant>'
            f'</x:period></x:context><t:A contextRef="c">{value}</t:A></x:xbrl>')


XSD = ('<s:schema xmlns:s="http://www.w3.org/2001/XMLSchema" xmlns:x="http://www.xbrl.org/2003/instance">'
       '<s:element id="t_A" name="A" type="x:monetaryItemType" x:periodType="instant"/></s:schema>')


def test_new_and_replaced_archives_are_parsed(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()

    def facts():
        return sorted((r["doc_id"], r["data_str"], r["instant_date"]) for r in X.instance_facts(X.archive_rows(spark, str(folder))).collect())

    _zip(folder / "S1.zip", **{"a.xbrl": _instance(1), "a.xsd": XSD, "a_def.xml": "<a/>"})
    assert facts() == [("S1", "1", "2024-01-01")] == facts()
    _zip(folder / "S2.zip", **{"a.xbrl": _instance(2), "a.xsd": XSD, "a_def.xml": "<a/>"})
    assert facts() == [("S1", "1", "2024-01-01"), ("S2", "2", "2024-01-01")]
    _zip(folder / "S1.zip", **{"a.xbrl": _instance("seven"), "a.xsd": XSD, "a_def.xml": "<a/>"})
    os.utime(folder / "S1.zip", (2_000_000_000, 2_000_000_000))
    assert facts() == [("S1", "seven", "2024-01-01"), ("S2", "2", "2024-01-01")]


def test_only_wanted_archives_are_parsed(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    for i in (1, 2, 3):
        _zip(folder / f"S{i}.zip", **{"a.xbrl": _instance(i), "a.xsd": XSD, "a_def.xml": "<a/>"})

    def parsed(docs=None):
        wanted = None if docs is None else spark.createDataFrame([(d,) for d in docs], "doc_id string")
        X.archive_rows(spark, str(folder), docs=wanted).count()
        return {r["path"].split("/")[-1] for r in spark.read.parquet(f"{folder}-rows/parsed").collect()}

    assert parsed([]) == set()
    assert parsed(["S2", "S2", "S9"]) == {"S2.zip"}
    assert {r["doc_id"] for r in X.archive_rows(spark, str(folder), docs=spark.createDataFrame([("S2",)], "doc_id string")).collect()} == {"S2"}
    assert parsed() == {"S1.zip", "S2.zip", "S3.zip"}


LABELS = ('<l:linkbase xmlns:l="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><l:labelLink>'
          '<l:loc xlink:href="x.xsd#t_A" xlink:label="a"/><l:label xlink:label="la" xlink:role="r/label" xml:lang="ja">{}</l:label>'
          '<l:labelArc xlink:from="a" xlink:to="la"/></l:labelLink></l:linkbase>')


def test_shared_labels_fill_what_a_filing_lacks(spark, tmp_path):
    (tmp_path / "f1_lab.xml").write_text(LABELS.format("first"))
    (tmp_path / "f2_lab.xml").write_text(LABELS.format("second"))
    (tmp_path / "f2_pre_x.xml").write_text(LABELS.format("").replace("labelLink", "presentationLink"))
    (tmp_path / "f3_lab.xml").write_text("<broken")
    rows = X.taxonomy_rows(spark, str(tmp_path))
    assert [r["doc_id"] for r in rows.filter("kind = 'error'").collect()] == ["f3_lab.xml"]
    shared = X.shared_labels(rows)
    assert [(r["key"], r["label_jp"]) for r in shared.collect()] == [("t:A", "first")]
    own = spark.createDataFrame([("D1", "t:A", None, None, "mine", None)],
                                "doc_id string, key string, label_jp string, label_jp_long string, label_en string, label_en_long string")
    accounts = spark.createDataFrame([("D1", "t:A"), ("D2", "t:A"), ("D2", "t:B")], "doc_id string, key string")
    got = {(r["doc_id"], r["key"]): (r["label_jp"], r["label_en"], r["label_source"]) for r in X.account_labels(accounts, own, shared).collect()}
    assert got == {("D1", "t:A"): (None, "mine", "own"), ("D2", "t:A"): ("first", None, "shared"), ("D2", "t:B"): (None, None, None)}


def test_files_of_one_archive_dont_multiply_facts(spark, tmp_path):
    _zip(tmp_path / "S3.zip", **{"a.xbrl": _instance(1), "b.xbrl": _instance(2).replace("2024", "2025"), "a.xsd": XSD, "b.xsd": XSD, "a_def.xml": "<a/>"})
    got = sorted((r["data_str"], r["instant_date"]) for r in X.instance_facts(X.archive_rows(spark, str(tmp_path))).collect())
    assert got == [("1", "2024-01-01"), ("2", "2025-01-01")]


def test_any_broken_archive_is_an_error_row(spark, tmp_path):
    (tmp_path / "S4.zip").write_bytes(b"no zip at all")
    _zip(tmp_path / "S5.zip", **{"a.xbrl": "<x", "a.xsd": XSD, "a_def.xml": "<a/>"})
    _zip(tmp_path / "S6.zip", **{"a.xbrl": b"<?xml version='1.0' encoding='nope'?><x/>", "a.xsd": XSD, "a_def.xml": "<a/>"})
    rows = X.archive_rows(spark, str(tmp_path)).filter("kind = 'error'").collect()
    assert {r["doc_id"] for r in rows} == {"S4", "S5", "S6"} and all(r["b"] for r in rows)


def test_runs_with_equal_chunk_ids_both_stay_and_retries_replace(spark):
    staging = work_dir(spark, "t-staging")
    for run, source, n in (("A", "remote", 2), ("B", "remote", 3), ("B", "remote", 3), ("A", "local", 1)):
        K.write_delta_chunk(spark.range(n), staging, run, "c1", source)
    got = S.staged_deltas(spark, staging).groupBy("run_id", "source").count().collect()
    assert {tuple(r) for r in got} == {("A", "local", 1), ("B", "remote", 3)}


def test_late_events_that_arent_repeats_are_kept(spark):
    folder = work_dir(spark, "t-events")
    for hour, ids in ((10, range(0, 10)), (11, range(10, 20)), (5, range(20, 30)), (5, [*range(30, 40), 25])):
        rows = spark.createDataFrame([(i,) for i in ids], "event_id long").withColumn("ts", F.to_timestamp(F.lit(f"2024-01-01 {hour:02d}:00:00")))
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    out = J.dedup_batches(J.file_stream(spark, folder, "events"), ["event_id"], "ts", "t-dedup")
    assert sorted(r["event_id"] for r in out.collect()) == list(range(40))


def test_a_repeat_with_another_time_is_absorbed(spark):
    folder = work_dir(spark, "t-repeats")
    for hour, ids in ((10, range(0, 10)), (20, [3, 4, 50]), (20, [50]), (1, [4, 60])):
        rows = spark.createDataFrame([(i,) for i in ids], "event_id long").withColumn("ts", F.to_timestamp(F.lit(f"2024-01-01 {hour:02d}:00:00")))
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    out = J.dedup_batches(J.file_stream(spark, folder, "events"), ["event_id"], "ts", "t-repeat")
    assert sorted(r["event_id"] for r in out.collect()) == [*range(10), 50, 60]


def test_upsert_stream_writes_only_touched_buckets(spark):
    folder = work_dir(spark, "t-upserts")
    for ids, value in ((range(200), 1), ([7], 2), ([7, 300], 3)):
        rows = spark.createDataFrame([(i, value) for i in ids], "id long, value long")
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    out = J.upsert_batches(J.file_stream(spark, folder, "events"), ["id"], ["value"], "t-upsert", n_buckets=16)
    assert {r["id"]: r["value"] for r in out.collect()} == {i: 1 for i in range(200)} | {7: 3, 300: 3}
    written = {}
    for f in out.inputFiles():
        written.setdefault(f.split("/part=")[1].split("/")[0], set()).add(f.rsplit("/", 1)[1].split("-", 2)[2])
    jobs = {j.split(".")[0].rsplit("-", 1)[0] for js in written.values() for j in js}
    assert len(jobs) > 1  # untouched partitions are still those of the first batch


def test_a_poll_updates_catalog_master_and_names(spark):
    """Late records change the history of their code; a corrected record takes its change away."""
    folder = work_dir(spark, "t-polls")
    polls = [[("d1", "JP:1", 1, 1, "A"), ("d3", "JP:1", 5, 3, "C"), ("d4", "JP:2", 2, 4, "X"), ("d5", "JP:2", 3, 5, "Y"), ("d6", None, 9, 6, "N")],
             [("d2", "JP:1", 3, 2, "B"), ("d1", "JP:1", 1, 1, "A")],  # late, and a repeat
             [("d4", "JP:2", 2, 4, "X"), ("d5", "JP:2", 4, 5, "X")]]  # d5 comes again, corrected
    for i, rows in enumerate(polls):
        df = spark.createDataFrame(rows, "doc_id string, code string, day int, seq_number long, company_name string")
        df = df.withColumn("submit_at", F.make_timestamp_ntz(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0))).drop("day")
        df.coalesce(1).write.mode("append").parquet(f"{folder}/polls.parquet")
    master = spark.createDataFrame([(0, "1", "2024-01-02"), (1, "JP:2", "2025-01-01"), (2, None, None)], "ordinal long, code string, last_submitted_at string")
    catalog, fresh, names = J.poll_batches(J.file_stream(spark, folder, "polls"), master, "t-poll", n_buckets=4)
    assert {(r["doc_id"], r["company_name"]) for r in catalog.collect()} == {
        ("d1", "A"), ("d2", "B"), ("d3", "C"), ("d4", "X"), ("d5", "X"), ("d6", "N")}
    assert {r["ordinal"]: r["last_submitted_at"] for r in fresh.collect()} == {0: "2024-01-05 00:00:00", 1: "2025-01-01", 2: None}
    assert sorted(tuple(r) for r in names.collect()) == [("JP:1", "A", "B", "2024-01-03"), ("JP:1", "B", "C", "2024-01-05")]


def test_late_states_change_the_names_of_their_code(spark):
    """Files overlap in time, a code holds a third of the states, and a state comes again, corrected."""
    folder = work_dir(spark, "t-changes")
    names = {(1 if i % 3 == 0 else i % 7 + 2, i): "ABC"[i * i % 5 % 3] for i in range(120)}
    for poll in range(4):
        rows = [(c, i, n if poll else "B") for (c, i), n in names.items() if i % 4 == poll or poll == 3 and i % 8 == 0]
        df = spark.createDataFrame(rows, "code long, seq_number long, company_name string")
        late = F.when(F.lit(poll == 3) & (F.col("seq_number") % 8 == 0), 1).otherwise(0)  # the correction's own second
        df = df.withColumn("submit_at", F.timestamp_seconds(1_700_000_000 + F.col("seq_number") * 1800 + late))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    want, last = [], {}
    for (c, i), n in sorted(names.items(), key=lambda kv: kv[0][1]):
        n = "B" if i % 8 == 4 else n  # the first poll's states that weren't corrected
        if last.get(c, n) != n:
            want.append((c, last[c], n))
        last[c] = n
    got = C.change_batches(J.file_stream(spark, folder, "events"), "t-changes")
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(want) and len(want) > 20


def test_versions_are_read_and_walked_without_limit(spark):
    root = work_dir(spark, "t-versions")
    spark.range(4).write.parquet(f"{root}/v=1")
    for v in range(2, 30):
        spark.range(0).write.parquet(f"{root}/v={v}")
    assert tuple(S.latest_healthy_version(spark, root).first()) == (1, 4)
    assert S.versions(spark, root)[-1] == 29 and S.load_version(spark, root, 1).count() == 4


def test_code_list_needs_its_header(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\nE00001,x\n", encoding="UTF-8")
    with pytest.raises(ValueError):
        S.read_code_list(spark, str(tmp_path), encoding="UTF-8")


def test_a_release_that_loses_rows_isnt_published(spark, monkeypatch):
    root = work_dir(spark, "t-publish")
    K.publish({"t": spark.range(5)}, root, 1)
    whole = K.write_table
    monkeypatch.setattr(K, "write_table", lambda df, path, *a, **b: (whole(df, path, *a, **b), whole(df.limit(2), path, *a, **b)))
    rows = K.publish({"t": spark.range(6)}, root, 2).collect()
    assert [r["ok"] for r in rows] == [False] and K.published_version(spark, root).first()["version"] == 1


def test_file_helpers(spark, tmp_path):
    with fs.open_output(f"file:{tmp_path}/x/y.bin") as f:
        f.write(b"abc")
    assert fs.exists(spark, f"{tmp_path}/x/y.bin") and fs.is_dir(spark, f"{tmp_path}/x") and not fs.is_dir(spark, f"{tmp_path}/x/y.bin")
    assert fs.folders(spark, str(tmp_path)) == ["x"] and fs.folders(spark, f"{tmp_path}/none") == []


def test_a_release_holds_the_bins_of_both_fact_kinds(spark):
    rows = {r["table"]: r["read_back"] for r in registry.queries()["delta_merge_release_all"](spark, SF_SMALL).collect()}
    facts = view(spark, SF_SMALL, "v_facts")
    for name, flag, keys in (("facts", 0, ["docid", "key", "context_ref"]), ("texts", 1, ["docid", "key"])):
        assert rows[name] == facts.filter(F.col("isTextBlock_flg") == flag).select(*keys).distinct().count() > 0


def test_every_turn_gets_a_prompt(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").groupBy("role").count().collect()
    got = registry.queries()["text_prompts_all"](spark, SF_SMALL).groupBy("role").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, turns)) and len(turns) > 1


def test_display_order_of_shared_subtrees_has_one_row_a_state(spark):
    """A ladder of diamonds has 2^20 paths, and twenty states of its ends."""
    edges, want = [], []
    for i in range(20):
        for side, order in (("a", 1.0), ("b", 2.0)):
            edges += [(f"n{i}", f"{side}{i}", "r", order), (f"{side}{i}", f"n{i + 1}", "r", order)]
        want.append(f"n{i + 1}")
    df = spark.createDataFrame(edges, "parent_key string, child_key string, role string, child_order double")
    rows = H.display_order(df, spark.createDataFrame([(k,) for k in want], "key string"), "r").collect()
    ends = {r["key"]: r["lvl"] for r in rows if r["key"] in want}
    assert ends == {f"n{i + 1}": 2 * (i + 1) for i in range(20)} and len(rows) == 20 + 2 * 19
    low = next(r["order"] for r in rows if r["key"] == "n1")
    assert low == round(1 + 1.0 * 0.01 + 1.0 * 0.0001, 10)  # the smaller of the two ways


def test_payloads_without_an_object(spark):
    from kaiji.operators import text as TX
    rows = spark.createDataFrame([('{"k": 1} {"k": 2}',), ("",), ("no object",), (None,)], "p string")
    o = TX.json_objects("p")
    got = rows.select(F.size(o), F.get_json_object(F.get(o, F.lit(0)), "$.k")).collect()
    assert [tuple(r)[1] for r in got] == ["1", None, None, None]


def test_scenarios_are_read_back(spark):
    from kaiji.operators import text as TX
    rows = [(1, '[{"ja":["軸","員"],"en":["Axis","M"],"id":["a","m"]},{"en":["B","N"]}]'), (2, "no json"), (3, None), (4, "{}"), (5, "[]"),
            (6, '[{"id":[1,{"x":2}]},7]')]
    df = spark.createDataFrame(rows, "i int, s string")
    got = [tuple(r) for r in df.select("i", F.inline(TX.dimension_members("s"))).collect()]
    assert got[:2] == [(1, 1, "軸", "員", "Axis", "M", "a", "m"), (1, 2, None, None, "B", "N", None, None)]
    assert [r[:2] for r in got[2:]] == [(6, 1), (6, 2)] and got[2][6] == "1"


def test_the_first_of_differing_repeats_stays(spark):
    folder = work_dir(spark, "t-first")
    for rows in ([(1, 5, "b"), (1, 5, "a"), (2, 9, "x")], [(1, 4, "z"), (2, 9, "x"), (2, 30, "w")]):
        df = spark.createDataFrame(rows, "event_id long, minute int, v string")
        df = df.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_000)).drop("minute")
        df.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    out = J.dedup_batches(J.file_stream(spark, folder, "events"), ["event_id"], "ts", "t-first")
    assert sorted((r["event_id"], r["v"]) for r in out.collect()) == [(1, "z"), (2, "x")]


def test_late_observations_are_settled_like_the_batch(spark):
    """Three kinds of one hot code and others; rows come in time, a poll late, and far behind the watermark."""
    import random
    rnd = random.Random(4)
    rows = [("k" + str(i % 3), 1 if i % 3 else i % 7, i * 700, i, rnd.choice(["A", "B"]), rnd.choice([0.0, 1.0, None])) for i in range(300)]
    folder = work_dir(spark, "t-observed")
    poll = lambda r: min(3, r[3] // 75 + (3 if r[3] % 20 == 0 else 1 if r[3] % 10 == 0 else 0))
    for p in range(4):
        df = spark.createDataFrame([r for r in rows if poll(r) == p], "kind string, code long, s long, seq long, text string, number double")
        df = df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).withColumn("kind", F.expr(
            "CASE kind WHEN 'k0' THEN 'name' WHEN 'k1' THEN 'listing' ELSE 'weight' END"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/seen.parquet")
    got = C.state_changes(J.file_stream(spark, folder, "seen"), "t-states", "14 hours")
    kinds, last, want = {"k0": "name", "k1": "listing", "k2": "weight"}, {}, []
    for k, code, _, _, text, number in sorted(rows, key=lambda r: r[2]):
        old, kind = last.get((k, code)), kinds[k]
        last[k, code] = (text, number)
        if kind == "name":
            kind = "NAME" if old and old[0] != text else None
        elif kind == "listing":
            was = old[1] if old else None
            kind = ("LISTING" if number == 1 else None) if not old else "DELISTING" if (was, number) == (1, 0) else "LISTING" if (was, number) == (0, 1) else None
        else:
            kind = None if not old or old[1] == number else "ADD" if old[1] is None else "REMOVE" if number is None else "UPDATE"
        if kind:
            want.append((kinds[k], str(code), kind, number if kinds[k] != "name" else text))
    have = [(r["kind"], r["code"], r["type"], r["new_text"] if r["kind"] == "name" else r["new_number"]) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr) and len(want) > 60


def test_a_large_partition_is_several_files(spark):
    from kaiji.sinks import tables as K
    root = work_dir(spark, "t-files")
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("part"))
    for _ in range(2):
        K.replace_partitions(rows, root, "part", lambda r: r.distinct(), file_rows=250)
    files = [f.split("part=")[1].split("/")[0] for f in spark.read.parquet(root).inputFiles()]
    assert spark.read.parquet(root).count() == 3000 and files.count("hot") >= 3 and max(files.count(x) for x in files if x != "hot") == 1


def test_rules_split_rows_and_count_breaks(spark):
    rules = (("a", ("0", "1"), False), ("b", ("x",), True))
    rows = [(1, "0", "x"), (2, None, None), (3, "2", "y"), (3, "2", "y"), (4, "1", None), (None, "", "X")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    good, rejects, metrics = V.split_by_rules(df, rules, work_dir(spark, "rules"))
    assert good.columns == df.columns
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    got = sorted(((r["id"], tuple(r["broken_rules"])) for r in rejects.collect()), key=repr)
    assert got == [(2, ("a",)), (3, ("a", "b")), (3, ("a", "b")), (None, ("a", "b"))]
    assert metrics == {"rows": 6, "rejects": 4, "a": 4, "b": 3}
    good, rejects, metrics = V.split_by_rules(df.limit(0), rules, work_dir(spark, "rules"))
    assert (good.count(), rejects.count(), metrics) == (0, 0, {"rows": 0, "rejects": 0, "a": 0, "b": 0})
    with pytest.raises(ValueError):
        V.split_by_rules(df.withColumn("Is_Valid", F.lit(1)), rules, work_dir(spark, "rules"))
