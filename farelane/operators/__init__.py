"""DataFrame -> DataFrame building blocks of the silver layer and its reports."""
