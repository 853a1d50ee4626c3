"""Journal macros of astronomy's LaTeX styles."""

from __future__ import annotations

from .base import int_to_roman

#: Macro and journal, a line each.
TABLE = """
aa	A&A
aap	A&A
ana	A&A
aapr	Astron. Astrophys. Rev.
aaps	A&AS
aasupp	A&AS
ag	AnGeo
aj	AJ
an	Astron. Nachr.
ao	Appl. Opt.
apj	ApJ
apjl	ApJ
apjlett	ApJ
apjs	ApJS
apjsupp	ApJS
apl	Astron. Lett.
aplett	Astrophys. Lett.
applopt	Appl. Opt.
apspr	Astrophys. Space Phys. Res.
apss	Ap&SS
aps	Ap&SS
araa	ARA&A
astap	A&A
aeta	A&A
aspcs	ASP Conference Proceedings
azh	AZh
baas	BAAS
bain	Bull. Astron. Inst. Netherlands
fcp	Fundam. Cosmic Phys.
gca	Geochim. Cosmochim. Acta
grl	Geophys. Res. Lett.
iaucirc	IAU Circ.
jcp	J. Chem. Phys.
jfm	J. Fluid Mech.
jgr	J. Geophys. Res.
jqsrt	J. Quant. Spec. Radiat. Transf.
jrasc	JRASC
memras	MmRAS
memsai	Mem. Soc. Astron. Italiana
mnras	MNRAS
nar	New Astron. Rev.
nat	Nature
nphysa	Nucl. Phys. A
pasj	PASJ
pasp	PASP
physrep	Phys. Rep.
physscr	Phys. Scr.
planss	Planet. Space Sci.
pp	Phys. Plasmas
pra	Phys. Rev. A
prb	Phys. Rev. B
prc	Phys. Rev. C
prd	Phys. Rev. D
pre	Phys. Rev. E
prl	Phys. Rev. Lett.
procspie	Proc. SPIE
qjras	QJRAS
rma	Rev. Mod. Astron.
rmaa	Rev. Mex. Astron. Astrofis.
rmaasc	Rev. Mex. Astron. Astrof. Conf. Ser.
skytel	S&T
sol	Sol. Phys.
solphys	Sol. Phys.
sph	Sol. Phys.
sovast	Soviet Astron.
sp	Sol. Phys.
ssr	Space Sci. Rev.
via	Vistas in Astronomy
zap	Z. Astrophys.
"""

MACROS = {f"\\{name}": journal for name, journal in (line.split("\t") for line in TABLE.strip().splitlines())}
MACROS |= {f"\\adass{int_to_roman(n).lower()}": f"Astronomical Data Analysis Software and Systems {int_to_roman(n)}" for n in range(1, 21)}
