"""Operators over envelopes and typed tables; each takes and returns DataFrames."""
