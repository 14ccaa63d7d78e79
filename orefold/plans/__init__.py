"""Layer plans: bronze, silver, gold dimensions, gold fact, marts, and the run that chains them."""
