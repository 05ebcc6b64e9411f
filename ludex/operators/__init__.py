"""Operators: each takes and returns DataFrames; column names are fixed by
the normalised log (user_id, item, behaviour, hours, ts, event_id, rkey)."""
