"""Sources: message streams (S1-S5), decoding, stored tables (S6-S7) and the
mappings that turn the test tables into transactions."""
