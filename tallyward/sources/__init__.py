"""Reading the warehouse relations, staging results, and writing outputs."""
