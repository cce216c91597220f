"""Ready-made queries over entries: dashboard, rules, alerts, exploration, quality reports.

They take frames with `ts`, `source`, `event_type`, `org` and either the decoded `payload` or the
JSON `line`, and anchor at event time: every range is given, none is the wall clock.
"""
