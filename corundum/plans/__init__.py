"""Registered queries: every job of the library over the driver tables, with its SQL counterpart."""
