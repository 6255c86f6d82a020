"""Constants of the instrument and its products.

Fixed values: they must be what they are for results to be right.
"""

from __future__ import annotations

#: Bands under order-sorting filter joints, and bands without signal.
ORDER_SORTING = (*range(29, 35), *range(69, 76), *range(162, 172))
NO_SIGNAL = (*range(1, 7), *range(252, 257))
#: Bands from which the surface temperature is estimated.
THERMAL_BANDS = (225, 246)
#: Physical constants as the calibration uses them, and the surface's emissivity.
LIGHT, PLANCK, BOLTZMANN, EMISSIVITY = 3e8, 6.626e-34, 1.38e-23, 0.95
#: Radiance of the products is in units of 0.01 W/m2/sr/um.
RADIANCE_SCALE = 0.01
#: Shape of the detector.
BANDS, SAMPLES = 256, 250
#: Z-scores beyond which gains and offsets of an exposure setting are outliers.
OUTLIER_Z = {"e1g2": (0.01, 0.5), "e2g2": (0.5, 0.1), "e3g2": (1.0, 0.1), "e4g2": (1.0, 1.0)}
#: Solar distances (au) of known observations; others are taken at 1.
SOLAR_DISTANCE = {
    "20201226T1745264921": 0.9855,
    "20210122T0920157625": 0.9849,
    "20210719T1622353775": 1.0174,
    "20210622T1850441449": 1.0184,
    "20210622T1454378054": 1.0184,
    "20210622T1256344234": 1.0184,
}
_MOON = 'GEOGCS["Moon 2000",DATUM["D_Moon_2000",SPHEROID["Moon_2000_IAU_IAG",1737400.0,0.0]],PRIMEM["Greenwich",0],UNIT["Decimal_Degree",0.0174532925199433]]'
#: Coordinate systems by name of projection and area.
PROJECTIONS = {
    "equatorial": f'PROJCS["Moon_Equidistant_Cylindrical",{_MOON},PROJECTION["Equidistant_Cylindrical"],PARAMETER["False_Easting",0],PARAMETER["False_Northing",0],PARAMETER["Central_Meridian",0],PARAMETER["Standard_Parallel_1",0],UNIT["Meter",1]]',
    "polarstereographicsouthpole": f'PROJCS["Moon_South_Pole_Stereographic",{_MOON},PROJECTION["Stereographic"],PARAMETER["False_Easting",0],PARAMETER["False_Northing",0],PARAMETER["Central_Meridian",0],PARAMETER["Scale_Factor",1],PARAMETER["Latitude_Of_Origin",-90],UNIT["Meter",1]]',
    "polarstereographicnorthpole": f'PROJCS["Moon_North_Pole_Stereographic",{_MOON},PROJECTION["Stereographic"],PARAMETER["False_Easting",0],PARAMETER["False_Northing",0],PARAMETER["Central_Meridian",0],PARAMETER["Scale_Factor",1],PARAMETER["Latitude_Of_Origin",90],UNIT["Meter",1]]',
}
#: Fields of a sun-parameter record.
SPM_FIELDS = "type row year month day hour minute second millisecond scx scy scz scvx scvy scvz phase sun_aspect sun_az sun_elev".split()
#: Folder of a file kind below a product level's name.
ARCHIVE_FOLDERS = {"png": "browse", "xml-png": "browse", "hdr": "data", "qub": "data", "xml": "data", "csv": "geometry", "xml-csv": "geometry", "lbr": "miscellaneous", "oat": "miscellaneous", "oath": "miscellaneous", "spm": "miscellaneous"}
LEVEL_NAMES = {0: "raw", 1: "calibrated", 2: "derived"}
LEVEL_CODES = {0: "nri", 1: "nci", 2: "ndi"}
