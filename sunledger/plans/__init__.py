"""One function per published view: ``view(tables, *, as_of) -> DataFrame``.

``as_of`` stands for "today", so that results never depend on the clock.  Views
come unsorted (a global sort is a shuffle nobody may need); ``catalog`` knows the
order a reader expects.
"""
