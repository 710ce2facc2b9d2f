import pytest
from oracle import compare, connect

from tessera.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small_data):
    return connect(small_data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, small_data, name):
    compare(con, spark, QUERIES[name], SQL[name], small_data)


def rows(spark, folder, name):
    return QUERIES[name](spark, folder).collect()


def table(con, sql):
    return con.execute(sql).fetchall()


def test_every_query_is_tested():
    """Queries without SQL are held by the tests below, by name."""
    assert set(QUERIES) - set(SQL) == {
        "p1_failures", "p1_valid", "p3_lifespans", "p3_table", "p4_found", "p4_classes", "p4_amounts", "p5_found", "p5_members",
        "load_observations", "load_compositions", "load_bilaterals", "load_rejected", "share_sum_check", "czech_order",
    }


def test_lines_are_parted(spark, con, small_data):
    bad = {r.raw_line_id: r for r in rows(spark, small_data, "p1_failures")}
    good = {r.raw_line_id: r for r in rows(spark, small_data, "p1_valid")}
    assert {(i, r.failure_code) for i, r in bad.items()} == set(table(con, SQL["p1_found"]))
    lines = dict(table(con, "select raw_line_id, line_text from raw_line where line_no > 1"))
    assert set(bad) | set(good) == set(lines) and not set(bad) & set(good)
    assert all(r.raw_input == lines[i] and r.n_edits == len(r.reason.split("; ")) > 0 for i, r in bad.items())
    for i, r in good.items():
        assert lines[i].lstrip('" ').startswith(r.source_key) and str(r.edition_year) in lines[i] and (r.amount is None or f"{abs(r.amount):,.10f}".rstrip("0").rstrip(".").replace(",", "") in lines[i].replace(",", ""))


def test_consistent_table(spark, con, small_data):
    every = rows(spark, small_data, "p3_table")
    staged = table(con, "select count(*) from (select distinct dataset_code, edition_year, source_key, coalesce(section_name,''), coalesce(field_name,''), coalesce(subfield_name,''), record_id, ordinal, case when raw_text is null or trim(lower(raw_text)) in ('','na','n/a','n.a.','negl','-','none reported','not available','unknown') then null else raw_text end from raw_field join artifact using (artifact_id) where parser_family is distinct from 'delimited_export' and dataset_code is not null and edition_year is not null)")
    assert len(every) == staged[0][0]
    assert all((r.value_number is None or r.value_type in ("whole", "decimal", "percentage")) and (r.value_date is None or r.value_type == "date") for r in every)
    assert not [r for r in every if r.value_type == "date" and r.value_text and r.value_date is None]
    spans = rows(spark, small_data, "p3_lifespans")
    assert all(r.first <= r.until for r in spans) and {(r.dataset_code, r.source_path) for r in every} == {(r.dataset_code, r.path) for r in spans}
    last = {(r.dataset_code, r.path) for r in spans}
    assert all((r.dataset_code, r.canonical_path) in last for r in spans)


def test_amounts_classes_and_pairs(spark, con, small_data):
    amounts = {r.parsed_value_id: r for r in rows(spark, small_data, "p4_amounts")}
    assert set(amounts) == {i for (i,) in table(con, "select parsed_value_id from parsed_value")}
    assert all((r.base_amount is None) == (r.amount_reason is not None) for r in amounts.values())
    key = lambda r: (r.dataset_code, r.source_key, r.metric_code, r.reference_year)
    held = [r for r in amounts.values() if r.base_amount and None not in key(r)]
    groups = {}
    for r in held:
        groups.setdefault(key(r), []).append((r.parsed_value_id, r.base_amount))
    want = {(min(i, j), max(i, j)) for g in groups.values() for i, x in g for j, y in g if i < j and x * y > 0 and abs(abs(x) - abs(y)) < 0.005 * max(abs(x), abs(y))}
    found = [tuple(r) for r in rows(spark, small_data, "p4_found")]
    assert set(found) == want and len(found) == len(want)
    classes = {r.parsed_value_id: r for r in rows(spark, small_data, "p4_classes")}
    assert set(classes) == {r.parsed_value_id for r in held}
    links = {}
    for i, j in found:
        links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
    assert all(r.links == links.get(i, 0) and r.class_id <= i for i, r in classes.items())


def test_members_of_lists(spark, con, small_data):
    found = [tuple(r) for r in rows(spark, small_data, "p5_found")]
    every = {(r.field_value_id, r.list_position, r.label) for r in rows(spark, small_data, "p5_members")}
    assert set(found) <= every and len(set(found)) == len(found)
    sizes = {}
    for i, position, label in found:
        sizes.setdefault(i, []).append(position)
        assert label == label.strip() and label
    assert all(sorted(p) == list(range(1, len(p) + 1)) and len(p) > 1 for p in sizes.values())
    assert {i for i, p, _ in every if p == 2} == set(sizes)


def test_loading_accounts_for_every_field(spark, con, small_data):
    """Each mapped field is an observation or a refusal; members and partners come from lists of theirs; nothing is lost or told twice."""
    from tessera.plans import claim_queries as cq

    kinds = {m[0]: m[1] for m in cq._MAPPED}
    fields = {i: (n, t) for i, n, t in table(con, "select field_value_id, field_name, raw_text from raw_field join artifact using (artifact_id)")}
    loaded = cq._load(spark, small_data)
    refused = [r.asDict() for r in loaded.rejected.collect()]
    observed = rows(spark, small_data, "load_observations")
    of = lambda kind: {i for i, (n, _) in fields.items() if kinds.get(n) == kind}
    assert sorted([r.field_value_id for r in observed] + [r["field_value_id"] for r in refused if r["field_value_id"] in of("observation")]) == sorted(of("observation"))
    assert all((r.value is not None) or r.missing_reason for r in observed)
    assert all(r["raw_input"] == fields[r["field_value_id"]][1] for r in refused)
    counts = {}
    for r in refused:
        counts[r["error_code"]] = counts.get(r["error_code"], 0) + 1
    assert {(r.error_code, r["values"]) for r in rows(spark, small_data, "load_rejected")} == set(counts.items())
    for name, kind in (("load_compositions", "composition"), ("load_bilaterals", "bilateral")):
        got = rows(spark, small_data, name)
        assert got and {r.field_value_id for r in got} <= of(kind) and len({(r.field_value_id, r.ordinal) for r in got}) == len(got)
        assert all(r.label.split()[0].strip("\"'“”„«»‹›:") in fields[r.field_value_id][1] for r in got)
    shares = {}
    for i, (n, text) in fields.items():
        if n in ("Ethnic groups", "Religions") and text:
            shares[i] = text
    off = {r.field_value_id: r for r in rows(spark, small_data, "share_sum_check")}
    assert set(off) <= set(shares) and all(abs(r.total - 100) > 25 and r.shares > 0 for r in off.values())


def test_czech_order(spark, small_data):
    labels = {r.source_key: r.label for r in spark.read.parquet(f"{small_data}/entity.parquet").collect() if r.label is not None}
    by_region = {}
    for r in QUERIES["czech_order"](spark, small_data).collect():
        by_region.setdefault(r.region_name, []).append((r.place, labels[r.source_key]))
    assert sum(map(len, by_region.values())) == len(labels)
    plain = [[x for _, x in sorted(v)] for v in by_region.values()]
    assert all([p for p, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in by_region.values())
    ascii_only = [[x.lower() for x in v if x.isascii() and x.isalpha() and "ch" not in x.lower()] for v in plain]
    assert all(v == sorted(v) for v in ascii_only)


def test_columns_of_found(spark, small_data):
    want = {
        "p1_found": [("raw_line_id", "bigint"), ("failure_code", "string")],
        "p3_found": [("dataset_code", "string"), ("edition_year", "int"), ("change_kind", "string"), ("old_path", "string"), ("new_path", "string")],
        "p4_found": [("parsed_value_id_a", "bigint"), ("parsed_value_id_b", "bigint")],
        "p5_found": [("field_value_id", "bigint"), ("list_position", "int"), ("label", "string")],
    }
    for name, columns in want.items():
        assert QUERIES[name](spark, small_data).dtypes == columns
