"""Jobs on DataFrames: plan generation, result cleaning, accounting, ledgers, triggers, quality."""
