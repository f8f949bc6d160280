"""Registered queries: every operator run over the test tables, with an SQL oracle."""
