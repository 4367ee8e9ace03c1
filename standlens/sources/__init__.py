from standlens.sources.schemas import STANDS, COMPARTMENTS, DOMAIN
from standlens.sources.readers import clean_names, read_stands, read_compartments, read_domains
from standlens.sources.fixture import Inputs, tpch_inputs

__all__ = ["STANDS", "COMPARTMENTS", "DOMAIN", "clean_names", "read_stands",
           "read_compartments", "read_domains", "Inputs", "tpch_inputs"]
