"""The registered queries, their SQL counterparts, and whole report runs."""
