"""MLlib count models, the missingness-aware ensemble, bake-off and hold-out scoring."""
