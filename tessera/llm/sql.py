"""SQL of the text queries that SQL can express."""

_ITEMS = r"""
WITH e AS (SELECT item_id, unnest(string_split_regex(coalesce(attrs, ''), '[;|,\n]')) AS entry FROM catalogue_item),
a AS (SELECT item_id, list_sort(list(regexp_replace(lower(nfc_normalize(entry)), '[^\p{L}\p{N}\p{M}]', '', 'g'))) AS attrs FROM e GROUP BY item_id),
c AS (SELECT item_id, name AS raw_name, url AS raw_url, catalogue_item.attrs AS raw_attrs,
  regexp_replace(lower(nfc_normalize(coalesce(name, ''))), '[^\p{L}\p{N}\p{M}]', '', 'g') AS n,
  regexp_replace(lower(nfc_normalize(coalesce(url, ''))), '[^\p{L}\p{N}\p{M}]', '', 'g') AS u, a.attrs AS t
  FROM catalogue_item LEFT JOIN a USING (item_id)),
g AS (SELECT *, min(item_id) OVER (PARTITION BY n, u, t) AS kept FROM c)
"""

SQL = {
    "p6_found": _ITEMS + "SELECT kept AS item_id_kept, item_id AS item_id_copy FROM g WHERE kept <> item_id",
    "p6_records": _ITEMS
    + """SELECT kept AS item_id_kept, arg_min(raw_name, item_id) AS name, arg_min(raw_url, item_id) FILTER (WHERE item_id = kept) AS url, arg_min(raw_attrs, item_id) AS attrs,
  count(*) AS copies, count(DISTINCT (raw_name, raw_url, raw_attrs)) AS variants FROM g GROUP BY kept""",
}
