"""forgeline: order, geometry and cost tables on Spark, and operators for training corpora."""
