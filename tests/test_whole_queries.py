"""Queries run on whole tables."""

from telemark.plans import system_queries
from telemark.plans.panels import part_panel


def test_snapshot_sequence_loads_every_day(spark, sf_dir, monkeypatch):
    loaded = []

    class Watched(system_queries.Lake):
        def replace_days(self, table, rows, days, **more):
            loaded.append((rows.count(), len(days)))
            return super().replace_days(table, rows, days, **more)

    monkeypatch.setattr(system_queries, "Lake", Watched)
    system_queries.snapshot_sequence(spark, sf_dir)
    panel = part_panel(spark, sf_dir)
    assert loaded[0] == (panel.count(), panel.select("date").distinct().count())
