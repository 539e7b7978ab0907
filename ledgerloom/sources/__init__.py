"""Reading, deriving, staging and writing the domain tables."""
