CREATE TABLE IF NOT EXISTS `desa_landing__water_ops`.`meter_reading` (
  `meter` STRING NOT NULL COMMENT 'Serial number of the meter.',
  `read_on` DATE NOT NULL COMMENT 'Day of the reading.',
  `read_at` TIMESTAMP NOT NULL COMMENT 'Time the reading came in.',
  `plant` STRING NOT NULL COMMENT 'Waterworks that feeds the meter.',
  `street` STRING COMMENT 'Street of the connection.',
  `method` STRING NOT NULL COMMENT 'How it was read.',
  `litres` DECIMAL(14,3) NOT NULL COMMENT 'Litres since the reading before.',
  `litres_billed` DECIMAL(14,3) COMMENT 'Litres billed; empty until the bill is out.',
  `tariff` DECIMAL(8,4) COMMENT 'Price of a thousand litres.',
  `verified` BOOLEAN NOT NULL COMMENT 'Seen by a second person.',
  `reader` STRING NOT NULL COMMENT 'Who or what read it.'
) USING parquet
LOCATION '/lake/desa_landing__water_ops/meter_reading/meter_reading_v0'
COMMENT 'One row for each reading of a water meter.'
