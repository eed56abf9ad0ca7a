"""The layers as chains of operators: bronze, silver, gold, models, evaluation."""
