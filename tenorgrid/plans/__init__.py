"""Compositions: the decision spine, the ladders, the futures side, the basis panel and the reports on them."""
