"""tidymart: DataFrame operators that turn dirty categorical case data into a data mart."""
