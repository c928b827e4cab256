"""Expression helpers, see ``weirgauge.functions.expr``."""
