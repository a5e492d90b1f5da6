"""Joins, winners, outcomes and loads that every plan is made of."""
