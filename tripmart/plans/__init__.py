"""The layers: bronze, silver, gold, their checks and the jobs that build them."""
