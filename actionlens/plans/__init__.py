"""The analytics jobs. Each is a function of DataFrames and explicit parameters; none reads a clock."""
