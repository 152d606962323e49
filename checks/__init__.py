"""What the checks need: test tables turned into topics, the query list and its SQL twin."""
