"""JSON lists by year."""

import json

import __spark_entry__ as E
from arrivo.plans import queries_shaping


def test_json_lists_by_year(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_shaping, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = E.queries()["json_list_roundtrip"](spark, sf).collect()
    lists = [json.loads(p.read_text()) for p in (tmp_path / "list").rglob("part-*")]
    assert sorted(r["indice_tiempo"] for x in lists for r in x) == sorted(r.indice_tiempo for r in rows)
    assert len(lists) == len({r.indice_tiempo[:4] for r in rows}) > 1
    assert all(len({r["indice_tiempo"][:4] for r in x}) == 1 for x in lists)
